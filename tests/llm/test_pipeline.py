import __spark_entry__ as contract
import corpus_pipeline
import edge
from compare import DATA, connect, difference
from sedimenta.llm import bpe, decontamination, oracle, queries, secret_ledger, simhash
from test_secret_ledger import SECRETS, base

FOLDER = f"{DATA}/sf0.001"


def test_registered_by_name():
    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(oracle.statements()) <= set(queries.registered())


def test_stages_in_order_and_columns():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID",
        "SimHash near-dedup",
        "benchmark decontamination",
        "secret scans",
        "byte-level BPE",
    ]


def stages(spark, docs, folder):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        out[name] = docs
    return out


def test_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    done = stages(spark, docs, FOLDER)
    names = list(done)
    for name in names[:-1]:
        assert done[name].columns == docs.columns
    ids = [[row.doc_id for row in frame.select("doc_id").collect()] for frame in done.values()]
    groups = simhash.near_duplicates(done[names[0]]).select("component_id").distinct().collect()
    assert sorted(ids[1]) == sorted(row.component_id for row in groups) and len(ids[1]) < len(ids[0])
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    dirty = decontamination.contamination(done[names[1]], items).where("contaminated").collect()
    assert set(ids[1]) - set(ids[2]) == {row.doc_id for row in dirty} and dirty
    assert sorted(ids[2]) == sorted(ids[3]) == sorted(ids[4])
    assert not any(base(row.text) for row in done[names[3]].collect())
    whole = bpe.decode(done[names[4]]).join(done[names[3]].select("doc_id", "text"), "doc_id").collect()
    assert len(whole) == len(ids[4]) and all(bytes(row.decoded).decode() == row.text for row in whole)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "ids", "n_tokens"] and out.count() > 0


def test_edge_rows_through_all_stages(spark, tmp_path):
    items = spark.createDataFrame([(1, edge.prose(77, 20))], "item_id long, text string")
    planted = edge.prose(70, 15) + " " + edge.prose(77, 20)
    data = edge.rows() + SECRETS + [(70, planted, "en", "z", 5)]
    df = edge.clashing(edge.frame(spark, data), "ids", "n_tokens", "blob", "_address")
    folder = edge.folder_of(df, tmp_path / "in", benchmark=items)
    done = stages(spark, df, folder)
    last = {row.doc_id for row in done["byte-level BPE"].collect()}
    assert 70 not in last and 3 not in last and 4 not in last and {1, 6, 50} <= last and 2 not in last
    masked = {row.doc_id: row for row in done["secret scans"].collect()}
    assert secret_ledger.MASK in masked[50].text and masked[50].n_chars == len(masked[50].text)


def test_columns_of_any_name_keep_their_values(spark, tmp_path):
    """Every name that a stage uses inside, as a column of the user's."""
    names = "_language _fingerprint _kept_key _kept_value _address _blob _findings _masked _rows _kept value key of rows blob"
    items = spark.createDataFrame([(1, edge.prose(77, 20))], "item_id long, text string")
    data = [row for row in edge.rows() + SECRETS if row[0] is not None]
    df = edge.clashing(edge.frame(spark, data), *names.split())
    folder = edge.folder_of(df, tmp_path / "in", benchmark=items)
    done = stages(spark, df, folder)
    for name, frame in done.items():
        rows = frame.select(*names.split()).distinct().collect()
        assert [tuple(row) for row in rows] == [("taken",) * len(names.split())], name
    assert 50 in {row.doc_id for row in done["secret scans"].collect()}


def test_empty_table(spark, tmp_path):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    df = edge.frame(spark, [])
    for frame in stages(spark, df, edge.folder_of(df, tmp_path / "in", benchmark=items)).values():
        assert frame.count() == 0


def test_all_sql(spark):
    con = connect(FOLDER)
    for name, sql in oracle.statements().items():
        assert difference(queries.registered()[name](spark, FOLDER), con, sql) is None
