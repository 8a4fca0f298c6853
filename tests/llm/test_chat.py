import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import edge
from compare import DATA, connect, difference
from sedimenta.llm import chat, oracle, queries

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["<|im_end|>", "\\", "<|", "|", "<", "\n", "a", "</s>", "[INST]", "[/INST]", "<s>", "é", "😀", " ", "\\n"]
PARTS += ["<|im_start|>", "[", "s>", "<|im_sep|>"]


def turns():
    draw = random.Random(4)
    make = lambda n: "".join(draw.choice(PARTS) for _ in range(draw.randint(0, n)))
    out = [(None, 0, "user", "x"), (7, 0, "assistant", "dup"), (7, 0, "assistant", "dup"), (50, 3, "system", "only")]
    for conv in range(30):
        for turn in range(draw.randint(1, 30)):
            role = draw.choice(["user", "assistant", "system", None, make(4)]) if turn else draw.choice(["system", "user"])
            text = None if draw.random() < 0.05 else make(60)
            out.append((conv, turn if draw.random() < 0.9 else None, role, text))
    return out + [(60, i, "assistant", "long " * 3000) for i in range(3)]


def ordered(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((-1 if turn is None else turn, role or "", text or ""))
    for own in found.values():
        own.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
    return found


@pytest.mark.parametrize("budget, history", [(60, 10), (200, 40), (1024, 192)])
def test_round_trip(spark, budget, history):
    df = spark.createDataFrame(turns(), SCHEMA)
    windows = chat.windows(edge.clashing(df, "window", "formatted"), budget=budget, history=history)
    out = {row.conv_id: row for row in chat.read_back(windows).collect()}
    want = ordered(turns())
    assert set(out) == set(want)
    for conv, own in want.items():
        assert [(turn.role, turn.text) for turn in out[conv].turns] == [turn[1:] for turn in own]
        assert list(out[conv].trained) == [text for _, role, text in own if role == "assistant"]


def size(role, text):
    return -(-len((role + text).encode()) // 4) + 4


def plain_windows(own, budget, history):
    """Repeated and fresh turns of each window of a conversation of (role, text), by a loop over its turns."""
    sizes = [size(*turn) for turn in own]
    retained = own[0][0] == "system"
    kept = sizes[0] if retained else 0
    room = max(budget - kept, 0)
    near = min(history, room // 2)
    stride = max(room - near, 1)
    starts = [0 if retained and i == 0 else sum(sizes[:i]) - kept for i in range(len(own))]
    cells = defaultdict(list)
    for i, start in enumerate(starts):
        cells[start // stride].append(i)
    spans = []
    for _, cell in sorted(cells.items()):
        turns = [i for i in cell if not (retained and i == 0)]
        if len(turns) > 1 and sum(sizes[i] for i in turns) > room:
            spans += [cell[:-1], cell[-1:]]
        else:
            spans.append(cell)
    for span in spans:
        turns = [i for i in span if not (retained and i == 0)]
        left = min(near, max(room - sum(sizes[i] for i in turns), 0))
        first = span[0]
        while first - 1 >= retained and sizes[first - 1] <= left:
            first -= 1
            left -= sizes[first]
        system = [0] if retained and span[0] != 0 else []
        yield system + list(range(first, span[0])), span


@pytest.mark.parametrize("seed", range(3))
def test_windows_against_a_loop_and_within_the_budget(spark, seed):
    draw = random.Random(seed)
    conversations = [[("user", "u" * n) for n in (364, 364, 364, 360, 2780, 180, 220)]]  # 96, 96, 96, 95, 700, 50, 60 tokens
    for _ in range(60):
        longest = draw.choice([20, 200, 1500, 6000])
        first = [("system", "s" * draw.choice([5, 400, 3500, 5000]))] if draw.random() < 0.5 else []
        turns = [(draw.choice(["user", "assistant"]), "w" * draw.randint(0, longest)) for _ in range(draw.randint(0, 60))]
        conversations.append(first + turns or [("user", "")])
    rows = [(i, j, *turn) for i, own in enumerate(conversations) for j, turn in enumerate(own)]
    found = defaultdict(list)
    for row in chat.windows(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "window").collect():
        found[row.conv_id].append(row)
    longer = 0
    for i, own in enumerate(conversations):
        want = list(plain_windows(own, chat.BUDGET, chat.HISTORY))
        assert len(want) == len(found[i])
        for (repeated, fresh), row in zip(want, found[i]):
            shown = [f"<|im_start|>{role}<|im_sep|>{text}<|im_end|>\n" for role, text in own]
            head = "".join(shown[j] for j in repeated)
            assert row.formatted == head + "".join(shown[j] for j in fresh) and row.fresh == len(head)
            masked = [row.formatted[s.start : s.start + s.length] for s in row.loss]
            assert masked == [own[j][1] for j in fresh if own[j][0] == "assistant"]
            if sum(size(*own[j]) for j in repeated + fresh) > chat.BUDGET:
                longer += 1
                turns = [j for j in repeated + fresh if j or own[0][0] != "system"]
                assert len(turns) <= 1
    assert longer


def test_budget_system_turn_and_history(spark):
    rows = [(1, 0, "system", "rules")] + [(1, i, "user" if i % 2 else "assistant", "w" * 100) for i in range(1, 60)]
    found = chat.windows(spark.createDataFrame(rows, SCHEMA), budget=400, history=80).orderBy("window").collect()
    assert len(found) > 5
    for i, row in enumerate(found):
        pieces = row.formatted.split(chat.END)[:-1]
        assert pieces[0] == "<|im_start|>system<|im_sep|>rules"
        tokens = sum(-(-len(p.replace("<|im_start|>", "").replace("<|im_sep|>", "").encode()) // 4) + 4 for p in pieces)
        assert tokens <= 400
        repeated = row.formatted[: row.fresh].count(chat.END)
        assert repeated in ((0,) if i == 0 else (2, 3))  # the system turn and one or two turns of 31 tokens
        masked = [row.formatted[s.start : s.start + s.length] for s in row.loss]
        assert masked == ["w" * 100] * row.formatted[row.fresh :].count("<|im_start|>assistant")


def test_query_reads_control_strings_back(spark, tmp_path):
    rows = turns()
    folder = tmp_path / "in"
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    out = {row.conv_id: row for row in queries.op4_chat_windows(spark, str(folder)).collect()}
    said = "</s>[INST] ok [/INST]"
    for conv, own in ordered([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)]).items():
        text = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        row = out[conv]
        assert (row.n_turns, row.turns_sha256) == (len(own), hashlib.sha256(text.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_empty_table(spark):
    assert chat.windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql(spark):
    folder = f"{DATA}/sf0.001"
    assert difference(queries.op4_chat_windows(spark, folder), connect(folder), oracle.CHAT) is None


def test_no_python_in_the_plan(spark):
    df = chat.read_back(chat.windows(spark.createDataFrame([], SCHEMA).select("*", F.lit(1).alias("extra"))))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
