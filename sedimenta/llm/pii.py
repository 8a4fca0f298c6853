"""Personal data: generators propose spans, boosted trees choose among them, all in columns and JVM-side models.

Base kinds (email, ip, card, phone) have exact rules and always stay. Wider generators propose whatever looks like
them: masked addresses, numbers in any grouping, colon addresses. Their candidates overlap each other and the base
spans. Gradient-boosted trees are trained to tell, from format and context alone, confirmed spans rewritten to wider
forms (masked, without a plus and in other groups, in colons) from numbers that are none by their length, place or
grouping; the score from which a kind's candidates are redacted is calibrated on some that were not trained on. Chosen
spans that no base span or longer chosen span overlaps are added.

Numbers without a plus are only added where they are written in groups: a run of digits alone cannot be told from an id.

Positions come from splitting a text at a pattern: the pieces between matches and the matches themselves add up. The
patterns take time linear in the text: runs are possessive and begin only where no character of theirs precedes (or
where the match before ended), and repeated groups are bounded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import stored

_LOCAL, _NAME = "A-Za-z0-9._%+-", "[A-Za-z0-9-]"
#: Kind, pattern, and a string or pattern without which a text is not searched.
BASE = {
    "email": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_NAME}+(?:\.{_NAME}++)+", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    # A whole run of digits with single blanks or hyphens between; runs of other lengths fail whole.
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])", r"[0-9][\x20-]?[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
WIDE = {
    "address": (
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++\x20?[(\[]at[)\]]\x20?{_NAME}++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?{_NAME}++){{1,5}}",
        r"[(\[]at[)\]]",
    ),
    "number": (r"(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9])", r"[0-9][\x20().-]{0,2}[0-9]"),
    "colon": (r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])", ":"),
}
KINDS = [*BASE, *WIDE]
#: The share of chosen candidates that must be confirmed.
PRECISION = 0.99
TREES, DEPTH = 6, 4
CONTEXT = 24
FEATURES = ["breaks", "size", "digits", "letters", "groups", "separators", "plus", "at", "dots", "tail", "left", "right", "mail", "call", "pay", "net"]
_WORDS = {"mail": r"mail|contact", "call": r"tel|phone|call|fax|mobil", "pay": r"card|visa|konto|pay", "net": r"\bip\b|host|server|addr"}

#: Where the groups of a number begin, and what stands between them: four, seven and ten digits from its end, or every
#: four or two of them. Thousands are no phone number's groups.
GROUPS = [(ends, mark) for ends in ("(?:[0-9]{4}|[0-9]{7}|[0-9]{10})", "(?:[0-9]{4})+", "(?:[0-9]{2})+") for mark in " -"]
THOUSANDS = ("(?:[0-9]{3})+", " ")

_CANDIDATE = (
    "array<struct<kind: string, start: int, stop: int, base: boolean, breaks: int, size: int, digits: int, letters: int, groups: int, "
    "separators: int, plus: int, at: int, dots: int, tail: int, left: int, right: int, mail: int, call: int, pay: int, net: int, lead: string, value: string, trail: string>>"
)


def _searched(text: Column, pattern: str, needs: str) -> Column:
    return F.contains(text, F.lit(needs)) if len(needs) == 1 else F.rlike(text, F.lit(needs))


def _accepted(kind: str, value: Column) -> Column:
    """The exact rule of a base kind, on a match of its pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(
            F.split(value, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255"))
        )
    if kind == "card":
        reversed_digits = F.split(F.reverse(digits), "(?!^)(?!$)").cast("array<int>")
        doubled = F.transform(
            reversed_digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
        )
        return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _features(value: Column, before: Column, after: Column) -> list[Column]:
    """Format and context, as small integers; none of the exact rules' own tests."""

    def count(pattern):
        return F.regexp_count(value, F.lit(pattern))

    near = F.lower(F.right(before, F.lit(CONTEXT)))
    return [
        F.contains(value, F.lit(". ")).cast("int").alias("breaks"),
        F.length(value).alias("size"),
        count("[0-9]").alias("digits"),
        count("[A-Za-z]").alias("letters"),
        count("[0-9]+").alias("groups"),
        count("[^0-9A-Za-z]").alias("separators"),
        F.contains(value, F.lit("+")).cast("int").alias("plus"),
        F.contains(value, F.lit("@")).cast("int").alias("at"),
        count(r"\.").alias("dots"),
        F.length(F.regexp_extract(value, "[0-9]*$", 0)).alias("tail"),
        F.rlike(F.right(before, F.lit(1)), F.lit(r"[0-9A-Za-z_.+-]")).cast("int").alias("left"),
        F.rlike(F.left(after, F.lit(1)), F.lit(r"[0-9A-Za-z_-]")).cast("int").alias("right"),
        *[F.rlike(near, F.lit(pattern)).cast("int").alias(name) for name, pattern in _WORDS.items()],
    ]


def _spans(kind: str, found: Column) -> Column:
    """Candidates of a kind from an array of (match, piece before, piece after)."""

    def step(state, each):
        value = each["value"]
        stop = state["at"] + F.length(each["before"]) + F.length(value)
        base = _accepted(kind, value) if kind in BASE else F.lit(False)
        one = F.struct(
            F.lit(kind).alias("kind"),
            (stop - F.length(value)).alias("start"),
            stop.alias("stop"),
            base.alias("base"),
            *_features(value, each["before"], each["after"]),
            # Only confirmed spans are carried as text: they are rewritten for training.
            F.when(base, F.right(each["before"], F.lit(CONTEXT))).alias("lead"),
            F.when(base, value).alias("value"),
            F.when(base, F.left(each["after"], F.lit(CONTEXT))).alias("trail"),
        )
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(one).cast(_CANDIDATE)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_CANDIDATE).alias("out"))
    return F.aggregate(F.filter(found, lambda x: x["value"].isNotNull()), start, step, lambda state: state["out"])


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, a ``row`` number and ``candidates`` of all kinds, one row per document; a map without a shuffle."""
    rows = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("text"))
    patterns = BASE | WIDE
    matched = rows.select(
        key,
        *[
            F.when(_searched(F.col("text"), *spec), F.regexp_extract_all("text", F.lit(spec[0]), F.lit(0))).alias(f"m_{kind}")
            for kind, spec in patterns.items()
        ],
        "text",
    )
    # Cut only where something matched: most texts are never copied.
    pieces = matched.select(
        key,
        *[f"m_{kind}" for kind in patterns],
        *[
            F.when(F.size(f"m_{kind}") > 0, F.split("text", spec[0], -1)).alias(f"p_{kind}")
            for kind, spec in patterns.items()
        ],
    )

    def zipped(kind):
        pairs = F.arrays_zip(
            F.col(f"m_{kind}").alias("value"),
            F.col(f"p_{kind}").alias("before"),
            F.slice(f"p_{kind}", F.lit(2), F.greatest(F.size(f"m_{kind}"), F.lit(0))).alias("after"),
        )
        return F.coalesce(_spans(kind, pairs), F.array().cast(_CANDIDATE))

    return pieces.select(key, F.concat(*[zipped(kind) for kind in patterns]).alias("candidates")).withColumn(
        "row", F.monotonically_increasing_id()
    )


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def _addable(rows: DataFrame) -> DataFrame:
    """Wide candidates that no base span overlaps, one by one: those that can be added."""
    sure = F.filter("candidates", lambda c: c["base"])
    free = F.filter("candidates", lambda c: c["kind"].isin(*WIDE) & ~F.exists("sure", lambda s: _overlaps(s, c)))
    return rows.withColumn("sure", sure).select("row", F.posexplode(free).alias("nth", "c")).select("row", "nth", "c.*")


def _labelled(rows: DataFrame) -> DataFrame:
    """Candidates of the wide kinds with ``label``, from evidence other than that a base span overlaps them.

    Positives are confirmed spans rewritten in their place: an address masked, a phone number without its plus as it
    was or in other groups, a host in colon form. Negatives are numbers in the texts of no phone's length, without
    groups or within longer words, and confirmed ones made wrong in the same groups: cards that fail the check digit,
    hosts with a part above 255 or as eight bytes, phone numbers cut short or written as a sum or a time, addresses that
    are the end of one sentence and the start of another.
    """
    sure = rows.select("row", F.posexplode(F.filter("candidates", lambda c: c["base"])).alias("nth", "c"))
    seeds = sure.select("row", "nth", "c.kind", "c.lead", "c.value", "c.trail")
    value, digits = F.col("value"), F.regexp_replace("value", "[^0-9]", "")
    local, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    mask = F.pmod(F.xxhash64("row", "nth"), F.lit(3))
    style, fault = [F.pmod(F.xxhash64(F.lit(seed), "row", "nth"), F.lit(n)) for seed, n in ((11, len(GROUPS) + 2), (13, 3))]

    def grouped(number, written):
        """``number`` in the groups of this row's style; as ``written``, where that is in groups, for the last two."""
        first, *others = [F.regexp_replace(number, f"(?<=[0-9])(?={ends}$)", mark) for ends, mark in GROUPS]
        out = F.when((style >= len(GROUPS)) & F.rlike(written, F.lit("[^0-9]")), written)
        for i, each in enumerate(others):
            out = out.when(style == i, each)
        return out.otherwise(first)

    masked = (
        F.when(mask == 0, F.concat(local, F.lit("[at]"), F.replace(host, F.lit("."), F.lit("[dot]"))))
        .when(mask == 1, F.concat(local, F.lit(" (at) "), F.replace(host, F.lit("."), F.lit(" (dot) "))))
        .otherwise(F.concat(local, F.lit(" (at) "), host))
    )
    # Country parts of one to three digits.
    longer = F.when(F.length(digits) < 13, F.substring(F.abs(F.xxhash64(F.lit(17), "row", "nth")).cast("string"), 1, 2))
    dialled = F.concat(F.left(F.coalesce(longer, F.lit("")), F.pmod(F.xxhash64(F.lit(19), "row", "nth"), F.lit(3)).cast("int")), digits)
    short_parts = F.regexp_replace(F.regexp_replace(F.md5("value"), "(.{4})(?=.)", "$1:"), "(?<=^|:)0+(?=[0-9a-f])", "")
    wrong = F.concat(
        F.expr("left(value, length(value) - 1)"), F.pmod(F.right(value, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string")
    )
    forms = F.array(
        F.struct(
            F.when(F.col("kind") == "email", masked)
            .when(F.col("kind") == "phone", grouped(dialled, F.regexp_replace("value", r"^\+", "")))
            .when(F.col("kind") == "ip", short_parts)
            .alias("form"),
            F.lit(1.0).alias("label"),
        ),
        F.struct(
            F.when(F.col("kind") == "card", grouped(F.regexp_replace(wrong, "[^0-9]", ""), wrong))
            .when(F.col("kind") == "email", F.concat(local, F.lit(" (at) "), F.replace(host, F.lit("."), F.lit(". "))))
            .when((F.col("kind") == "ip") & (fault == 0), F.regexp_replace(F.left(F.md5("value"), F.lit(16)), "(..)(?=.)", "$1:"))
            .when(F.col("kind") == "ip", F.regexp_replace("value", "^[0-9]+", "999"))
            .when((F.col("kind") == "phone") & (fault == 0), grouped(F.left(digits, F.lit(8)), F.left(digits, F.lit(8))))
            .when((F.col("kind") == "phone") & (fault == 1), F.regexp_replace(digits, f"(?<=[0-9])(?={THOUSANDS[0]}$)", THOUSANDS[1]))
            .when(F.col("kind") == "phone", F.regexp_replace(digits, "^(.{4})(..)(..)(..).*$", "$1-$2-$3 $4:00"))
            .alias("form"),
            F.lit(0.0).alias("label"),
        ),
    )
    rewritten = seeds.select("lead", "trail", F.explode(forms).alias("f")).where("f.form is not null").select(
        F.struct(F.length("lead").alias("from"), (F.length("lead") + F.length("f.form")).alias("to"), "f.label").alias("seed"),
        F.concat("lead", "f.form", "trail").alias("text"),
    )
    found = candidates(rewritten, "seed", "text").select("seed", "row", F.posexplode("candidates").alias("nth", "c"))
    within = (F.col("c.start") < F.col("seed.to")) & (F.col("c.stop") > F.col("seed.from")) & F.col("c.kind").isin(*WIDE)
    made = found.where(within & ~F.col("c.base")).select("row", "nth", "c.*", F.col("seed.label").alias("label"))
    unlike = ~F.col("digits").between(10, 15) | (F.col("separators") == 0) | (F.col("left") + F.col("right") > 0)
    other = _addable(rows).where((F.col("kind") == "number") & unlike)
    return made.unionByName(other.withColumn("label", F.lit(0.0)))


def _counted(labelled: DataFrame) -> DataFrame:
    """How often each kind, label, ``fold`` and combination of features occurs, as ``weight``.

    Features are small integers and repeat: the trees see every labelled candidate, as the weight of its like.
    """
    folded = labelled.withColumn("fold", F.pmod(F.xxhash64(F.lit(7), "row", "nth", "label"), F.lit(4)))
    return folded.groupBy("kind", "label", "fold", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def _lowest(bins: list) -> float | None:
    """The lowest score at and above which ``PRECISION`` of the held-out candidates are right."""
    right = seen = 0
    threshold = None
    for p, confirmed, n in sorted(bins, reverse=True):
        right, seen = right + confirmed, seen + n
        if right >= PRECISION * seen:
            threshold = p / 100
    return threshold


def choose(rows: DataFrame) -> DataFrame | None:
    """``row`` and ``chosen``: wide candidates that the trees of their kind score above the kind's calibrated threshold.

    The trees learn from all confirmed spans, rewritten right and wrong, and all other candidates with a label, three in
    four of them; the threshold is counted over the rest. A kind is added from the lowest score at which, among its
    held-out candidates, ``PRECISION`` of those above are right;
    not at all if there is no such score or there are not both right and wrong ones to learn from. None for no kind.
    """
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fitted = assembler.transform(stored(_counted(_labelled(rows)), "candidates-labelled"))
    seen = fitted.groupBy("kind").agg(*[F.count_distinct(F.when(c, F.col("label"))) for c in (F.expr("fold > 0"), F.expr("fold = 0"))])
    chance = vector_to_array("probability")[1]
    each, scored = assembler.transform(_addable(rows)), []
    for kind in sorted(kind for kind, learnt, held in seen.collect() if learnt == 2 and held):
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3, checkpointInterval=-1, weightCol="weight")
        model = trees.fit(fitted.where((F.col("fold") > 0) & (F.col("kind") == kind)))
        held = model.transform(fitted.where((F.col("fold") == 0) & (F.col("kind") == kind)))
        bins = held.groupBy(F.floor(chance * 100).alias("p")).agg(F.sum(F.col("label") * F.col("weight")), F.sum("weight")).collect()  # at most 101
        threshold = _lowest(bins)
        if threshold is not None:
            scored.append(model.transform(each.where(F.col("kind") == kind)).where(chance >= threshold).select("row", "kind", "start", "stop"))
    if not scored:
        return None
    scored = reduce(DataFrame.unionByName, scored)
    return scored.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct((F.col("start") - F.col("stop")).alias("shorter"), "start", "stop", "kind")))
        .alias("chosen")
    )


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key and ``spans`` (kind, start, stop in characters, base), base ones first.

    A NULL text counts as empty; documents without candidates have no spans; repeated rows stay apart; an empty table
    gives no rows; other columns play no part.
    """
    rows = stored(candidates(docs, key, text), "candidates")
    sure = F.transform(
        F.filter("candidates", lambda c: c["base"]),
        lambda c: F.struct(c["kind"], c["start"], c["stop"], F.lit(True).alias("base")),
    )
    chosen = choose(rows)
    if chosen is None:
        return rows.select(key, sure.alias("spans"))
    span = "array<struct<kind: string, start: int, stop: int, base: boolean>>"

    def add(kept, c):
        """The longest first; what a kept span overlaps is left out."""
        one = F.array(F.struct(c["kind"], c["start"], c["stop"], F.lit(False))).cast(span)
        return F.when(F.exists(kept, lambda k: _overlaps(k, c)), kept).otherwise(F.concat(kept, one))

    none = F.array().cast(chosen.schema["chosen"].dataType)
    joined = rows.join(chosen, "row", "left").select(
        key, sure.cast(span).alias("sure"), F.coalesce("chosen", none).alias("chosen")
    )
    return joined.select(key, F.aggregate("chosen", F.col("sure"), add).alias("spans"))


def ordered(spans: Column) -> Column:
    """Spans as ``kind:start:stop`` by start, then in the order of ``KINDS``."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(kinds, s["kind"]), s["kind"], s["stop"]))
    return F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
