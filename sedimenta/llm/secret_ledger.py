"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger holds which rules, each with a version, have
been run over which blob, and what they found. A scan takes the pairs of blob and rule version that the ledger has not
seen, reads one copy of each such blob, appends what it finds, and joins findings back to all paths that hold the blob.
Running it again costs the addresses only; a new version of one rule runs that rule alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import send_package, stored, unused

FINDING = "struct<rule: string, kind: string, start: int, stop: int>"
#: Todo rows (a digest, a path and rule names each) up to which they are broadcast to the texts.
BROADCAST_ROWS = 20_000
MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """``pattern``'s leftmost non-overlapping matches in a text that pass ``accepts``, if the text may have any."""

    kind: str
    version: int
    pattern: re.Pattern
    may_match: Callable[[str, str], bool]
    accepts: Callable[[re.Match], bool] = lambda match: True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str, lower: str) -> list[tuple[int, int]]:
        if not self.may_match(text, lower):
            return []
        return [m.span() for m in self.pattern.finditer(text) if self.accepts(m)]


def _has(*words: str) -> Callable[[str, str], bool]:
    return lambda text, lower: any(word in text for word in words)


_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX = str.maketrans({chr(c): "h" if chr(c) in "0123456789abcdef" else " " for c in range(128)})

#: In the order in which spans that start together are listed. The first three are the base rules.
RULES = (
    Rule(
        "assign",
        1,
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            re.IGNORECASE | re.ASCII,
        ),
        lambda text, lower: any(name in lower for name in _NAMES),
        lambda match: len(match[2]) >= 6,
    ),
    Rule("access", 1, re.compile(r"AKIA[A-Z0-9]+"), _has("AKIA"), lambda match: len(match[0]) >= 20),
    Rule("hex", 1, re.compile(r"[0-9a-f]{24,}"), lambda text, lower: "h" * 24 in text.translate(_HEX)),
    Rule("private_key", 1, re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"), _has("PRIVATE KEY-----")),
    Rule("forge", 1, re.compile(r"\bgh[oprsu]_[A-Za-z0-9]{36,}"), _has("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
    Rule("chat", 1, re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}"), _has("xox")),
    Rule("jwt", 1, re.compile(r"\beyJ[\w-]+\.eyJ[\w-]+\.[\w-]+", re.ASCII), _has("eyJ")),
)
BASE = ("assign", "access", "hex")


def findings(text: str, rules: Mapping[str, Rule], names: list[str]) -> list[dict]:
    """What the named rules find in a whole text; positions count characters."""
    lower = text.lower()
    return [
        {"rule": name, "kind": rules[name].kind, "start": start, "stop": stop}
        for name in names
        for start, stop in rules[name].spans(text, lower)
    ]


def address(text: str):
    """A version's content address; NULL has that of the empty text."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def read_ledger(spark, ledger: str) -> DataFrame:
    """Blobs, the rules run over them and their findings; empty where nothing has been scanned yet."""
    schema = f"blob string, rules array<string>, findings array<{FINDING}>"
    try:
        return spark.read.schema(schema).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def update_ledger(
    versions: DataFrame, addresses: DataFrame, ledger: str, path: str, text: str, rules: tuple[Rule, ...] = RULES
) -> None:
    """Scans the blobs among ``addresses`` (``path``, ``blob``) for which a rule version is new, and appends to the
    ledger. Copies of a blob are united before the shuffle; the join to its text is on blob and path, so copies of one
    text stay spread."""
    spark = versions.sparkSession
    send_package(spark)
    names = [rule.name for rule in rules]
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
    blobs = addresses.groupBy("blob").agg(F.min(path).alias("at"))
    pending = F.array_except(
        F.array(*[F.lit(name) for name in names]), F.coalesce("seen", F.array().cast("array<string>"))
    )
    todo = stored(
        blobs.join(seen, "blob", "left").select(F.col("blob").alias("todo"), "at", pending.alias("pending"))
        .where(F.size("pending") > 0),
        "todo",
    )
    few = todo.count() <= BROADCAST_ROWS
    texts = versions.select(F.col(path).alias("path"), F.col(text).alias("text"), address(text).alias("blob"))
    chosen = texts.join(
        F.broadcast(todo) if few else todo.hint("shuffle_hash"),
        (F.col("blob") == F.col("todo")) & F.col("path").eqNullSafe(F.col("at")),
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {rule.name: rule for rule in rules}
        finding = pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
        for batch in batches:
            blob, pending, text = batch.columns
            lists = [names.as_py() for names in pending]
            found = [findings(value.as_py() or "", known, names) for value, names in zip(text, lists)]
            yield pa.RecordBatch.from_arrays(
                [blob, pa.array(lists, pa.list_(pa.string())), pa.array(found, pa.list_(finding))],
                ["blob", "rules", "findings"],
            )

    result = f"blob string, rules array<string>, findings array<{FINDING}>"
    done = chosen.select("blob", "pending", "text").mapInArrow(scanned, result)
    done.dropDuplicates(["blob"]).write.mode("append").parquet(ledger)


def found_in(spark, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``findings`` of these rule versions, of blobs that have any."""
    current = F.array(*[F.lit(rule.name) for rule in rules])
    mine = F.filter("findings", lambda f: F.array_contains(current, f["rule"]))
    rows = read_ledger(spark, ledger).where(F.size("findings") > 0).select("blob", mine.alias("findings"))
    # A blob has one row for each time that a rule version was new to it.
    joined = rows.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings"))
    return joined.where(F.size("findings") > 0)


def scan(
    versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per version: ``path``, ``blob`` and its ``findings`` (rule, kind, start, stop in characters).

    ``ledger`` is a folder that outlives the call. A NULL text counts as empty and has no findings; repeated rows stay;
    an empty table adds nothing; other columns play no part.
    """
    addresses = stored(versions.select(path, address(text).alias("blob")), "addresses")
    update_ledger(versions, addresses, ledger, path, text, rules)
    found = found_in(versions.sparkSession, ledger, rules)
    return addresses.join(found, "blob", "left").select(
        path, "blob", F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings")
    )


def ordered(found, rules: tuple[Rule, ...] = RULES):
    """Findings as ``kind:start:stop`` by start, then by the rules' order; each place once."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    keyed = F.transform(found, lambda f: F.struct(f["start"], F.array_position(kinds, f["kind"]), f["kind"], f["stop"]))
    return F.transform(
        F.array_sort(F.array_distinct(keyed)), lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])
    )


def redact(docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every finding of the ledger masked in its text; overlapping spans become one mask."""
    send_package(docs.sparkSession)

    @F.arrow_udf("string")
    def masked(texts: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
        out = []
        for value, begin, end in zip(texts.to_pylist(), starts.to_pylist(), stops.to_pylist()):
            parts, at = [], 0
            for start, stop in sorted(zip(begin or [], end or [])):
                if start >= at:
                    parts += [value[at:start], MASK]
                at = max(at, stop)
            out.append("".join([*parts, value[at:]]) if value is not None else None)
        return pa.array(out, pa.string())

    own, blob, findings = (unused(docs, label) for label in ("_address", "_blob", "_findings"))
    found = found_in(docs.sparkSession, ledger, rules).select(
        F.col("blob").alias(blob), F.col("findings").alias(findings)
    )
    joined = docs.withColumn(own, address(text)).join(found.hint("shuffle_hash"), F.col(own) == F.col(blob), "left")
    new = masked(F.col(text), F.col(f"{findings}.start"), F.col(f"{findings}.stop"))
    changed = F.coalesce(F.when(F.col(findings).isNotNull(), new), F.col(text)).alias(text)
    return joined.select(*[changed if name == text else F.col(name) for name in docs.columns])
