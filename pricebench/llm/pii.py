"""Personal data by candidate gradient boosting, in built-in expressions and Spark's own trees.

Strict patterns with a check each give the base spans, which always stay. High-recall generators propose
more spans, which may overlap and may lie inside runs that a strict pattern took whole and then dropped.
Boosted trees score them by their format and context. What the strict patterns settle teaches the trees:
a candidate that is a base span is a true one, one that fails the check of its kind is not. Both are also
written the way people write them where no strict pattern looks: marks spelled out or in brackets, other
separators, groups of digits, no country code. Only these copies calibrate the threshold of each kind, on
candidates that no tree has seen, since what is left to judge looks like them.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebench.session import ensure_checkpoints, write_through

# The patterns of the contract, without loops that recurse or start over inside a run.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Generators: (kind, pattern). They need not be exact, only miss little.
GENERATORS = (
    ("email", EMAIL),
    ("email", r"(?<![\p{L}0-9])[\p{L}0-9._%+-]{1,64}+\s?(?:@|[(\[]at[)\]])\s?(?:[\p{L}0-9-]{1,63}+\s?(?:\.|[(\[]dot[)\]])\s?){1,5}\p{L}{2,}"),
    ("ip", IP),
    ("ip", r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])"),
    ("card", CARD),
    ("card", r"(?<![0-9])[0-9]{16,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ .-][0-9]{4}){3}(?![0-9])"),
    ("phone", PHONE),
    ("phone", r"(?:\+[0-9]{1,3}[ .-]?)?(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}(?:[ .-]\(?[0-9]{2,4}\)?){2,4}(?![0-9])"),
)
HINTS = (
    r"(?i)(?:mail|contact|write|@)",
    r"(?i)(?:\bip\b|host|server|address|login)",
    r"(?i)(?:card|visa|credit|carte|karte|tarjeta|payment)",
    r"(?i)(?:phone|tel|call|mobile|fax|fono)",
)
FEATURES = 28
CHUNK = 512
TRAIN_ROWS = 20_000
TREES, DEPTH = 20, 4
PRECISION = 0.99
SPAN = "struct<kind: int, start: int, end: int>"
PROPOSED = "struct<kind: int, start: int, end: int, match: string, before: string, after: string>"


def _append_sums(values: Column) -> Column:
    """Sums of all earlier values for each value of a short array."""
    start = F.struct(F.array().cast("array<int>").alias("sums"), F.lit(0).alias("total"))

    def step(acc: Column, value: Column) -> Column:
        return F.struct(
            F.concat(acc["sums"], F.array(acc["total"])).alias("sums"), (acc["total"] + value).alias("total")
        )

    return F.aggregate(values, start, step)["sums"]


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column) -> Column:
    """Exclusive running sums of a non-empty int array; appending stays inside chunks."""
    at = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
    chunks = F.transform(at, lambda c: F.slice(values, c * CHUNK + 1, F.lit(CHUNK)))

    def shifted(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, b: a + b))
        return F.flatten(F.zip_with(chunks, _append_sums(totals), lambda c, o: F.transform(_append_sums(c), lambda x: x + o)))

    return _with(chunks, shifted)


def matches(text: Column, pattern: str) -> Column:
    """All leftmost matches with their places in code points: array of (start, end, match)."""
    none = F.array().cast("array<struct<start: int, end: int, match: string>>")

    def place(found: Column) -> Column:
        def starts(between: Column) -> Column:
            lengths = F.zip_with(between, found, lambda b, m: F.length(b) + F.length(m))
            return F.zip_with(_with(lengths, running), between, lambda s, b: s + F.length(b))

        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        spans = F.zip_with(
            _with(between, starts),
            found,
            lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("match")),
        )
        return F.when(F.size(found) > 0, spans).otherwise(none)

    return _with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    return F.call_function("luhn_check", number)


def _octet(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 4) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def valid(kind: str, match: Column) -> Column:
    """The check that a match of a strict pattern has to pass."""
    number = digits(match)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _octet)
    if kind == "card":
        return F.length(number).between(16, 19) & luhn(number)
    if kind == "phone":
        return F.length(number).between(8, 15)
    return F.lit(True)


def _possible(text: Column, kind: str) -> Column:
    """Can a text hold a match at all? Most hold none, and are spared the patterns."""
    return F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]") if kind == "email" else text.rlike("[0-9]")


def base_spans(text: Column) -> Column:
    """Array of (kind number, start, end), by kind, then start."""

    def of(number: int, kind: str, pattern: str) -> Column:
        sound = F.filter(matches(text, pattern), lambda m: valid(kind, m["match"]))
        spans = F.transform(
            sound, lambda m: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
        )
        return F.when(_possible(text, kind), spans).otherwise(F.array().cast(f"array<{SPAN}>"))

    patterns = (EMAIL, IP, CARD, PHONE)
    return F.concat(*[of(n, kind, pattern) for n, (kind, pattern) in enumerate(zip(KINDS, patterns))])


def candidates(text: Column) -> Column:
    """Array of proposed spans with their kind, place, text and surroundings; they may overlap."""

    def of(kind: str, pattern: str) -> Column:
        def described(m: Column) -> Column:
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["match"].alias("match"),
                F.substring(text, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24))).alias("before"),
                F.substring(text, m["end"] + 1, F.lit(8)).alias("after"),
            )

        spans = F.transform(F.filter(matches(text, pattern), lambda m: F.length(m["match"]) >= 7), described)
        return F.when(_possible(text, kind), spans).otherwise(F.array().cast(f"array<{PROPOSED}>"))

    return F.array_distinct(F.concat(*[of(kind, pattern) for kind, pattern in GENERATORS]))


def _count(match: Column, pattern: str) -> Column:
    return F.length(match) - F.length(F.regexp_replace(match, pattern, ""))


def features() -> Column:
    """Format and context of a candidate row as a fixed number of doubles."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    number = digits(match)
    parts = [
        *[F.col("kind") == i for i in range(len(KINDS))],
        F.length(match),
        F.length(number),
        _count(match, r"\p{L}"),
        _count(match, r"[\s-]"),
        _count(match, r"\."),
        _count(match, r"[()\[\]]"),
        F.size(F.split(match, r"[^0-9]+")),
        match.startswith("+"),
        match.contains("@"),
        match.rlike(r"\.\p{L}{2,}$"),
        luhn(number),
        F.length(number).between(16, 19),
        F.length(number).between(8, 15),
        match.rlike(r"^[0-9]+(\.[0-9]+){3}$") & F.forall(F.split(match, r"\."), _octet),
        match.rlike(r"[\s-]{2,}"),
        before.rlike(r"[\p{L}0-9]$"),
        before.rlike(r"[0-9][\s.-]$"),
        before.rlike(r"[=\"':#]\s?$"),
        after.rlike(r"^[\p{L}0-9]"),
        after.rlike(r"^[\s.-][0-9]"),
        *[before.rlike(hint) for hint in HINTS],
    ]
    assert len(parts) == FEATURES
    return F.array(*[F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts])


def _overlaps(spans: Column) -> Column:
    return F.exists(
        spans, lambda s: (s["kind"] == F.col("kind")) & (s["start"] < F.col("end")) & (s["end"] > F.col("start"))
    )


def _labelled(rows: DataFrame) -> DataFrame:
    """Label 1 for base spans, 0 for what fails its kind's check, null for what the patterns leave open."""
    same = F.exists(
        F.col("base"), lambda s: (s["kind"] == F.col("kind")) & (s["start"] == F.col("start")) & (s["end"] == F.col("end"))
    )
    number = digits(F.col("match"))
    fails = reduce(
        lambda a, b: a | b,
        [
            (F.col("kind") == 1) & F.col("match").rlike(r"^[0-9.]+$") & ~valid("ip", F.col("match")),
            (F.col("kind") == 2) & ~(F.length(number).between(16, 19) & luhn(number)),
            (F.col("kind") == 3) & ~F.length(number).between(8, 15),
            (F.col("kind") == 0) & ~F.col("match").rlike(r"\p{L}{2,}$"),
        ],
    )
    return rows.withColumn("label", F.when(same, 1.0).when(fails, 0.0))


AT = (" [at] ", "(at)", " @ ", "[at]", " (at) ")
DOT = (" [dot] ", "(dot)", ".", "[dot]", ".")
BETWEEN = (".", "-", " ", "", ". ")


def _distorted(rows: DataFrame) -> DataFrame:
    """Labelled candidates once more, in a form that the strict patterns pass over; which one, a hash decides.

    Emails get their marks spelled out, cards other groups and separators, phones lose their country code and get
    other separators, addresses get brackets around their dots. True and false candidates are treated alike.
    """
    turn = F.pmod(F.xxhash64(F.lit("form"), "k", "h", "kind", "start", "end"), F.lit(len(AT))).cast("int")
    one_of = lambda forms: F.get(F.array(*[F.lit(f) for f in forms]), turn)
    match = F.col("match")
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    email = F.concat(local, one_of(AT), F.replace(domain, F.lit("."), one_of(DOT)))
    card = F.regexp_replace(digits(match), F.lit("([0-9]{4})(?=[0-9])"), F.concat(F.lit("$1"), one_of(BETWEEN)))
    bare = F.regexp_replace(match, r"^\+[0-9]{1,3}[ .-]?", "")
    plain = F.regexp_replace(bare, "[()]", "")
    phone = F.when(turn < 2, bare).otherwise(F.regexp_replace(plain, F.lit(r"[\x20.-]+"), one_of(("-", "-", ".", "-", " "))))
    spelled = F.when(F.col("kind") == 0, email).when(F.col("kind") == 2, card).when(F.col("kind") == 3, phone)
    return rows.withColumn("match", spelled.otherwise(F.replace(match, F.lit("."), F.lit("[.]"))))


def _fold() -> Column:
    return F.pmod(F.xxhash64(F.lit("fold"), "k", "h", "kind", "start", "end"), F.lit(4))


def _draw() -> Column:
    """A hash of a candidate, by which training rows are drawn."""
    return F.xxhash64("k", "h", "kind", "start", "end")


def fit(rows: DataFrame, most: int = TRAIN_ROWS) -> tuple[GBTClassificationModel, list[float]] | None:
    """Trees from at most ``most`` labelled candidates (a documented bound), and one threshold per kind from all.

    Of each kind and label an equal share with the smallest hashes is drawn, so no kind crowds out another; half
    of the rows are the candidates as they stand, half their distorted copies. A quarter of all candidates is
    never drawn. Thresholds are calibrated on the distorted copy of every labelled candidate that is not in the
    draw. None if there is nothing to learn from.
    """
    known = rows.filter(F.col("label").isNotNull()).withColumns({"fold": _fold(), "draw": _draw()})
    place = Window.partitionBy("kind", "label").orderBy("draw", "k", "h", "start", "end")
    chosen = (
        known.filter("fold > 0")
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= max(1, most // (4 * len(KINDS))))
        .drop("place")
    )
    columns = "kind", "label", "draw", features().alias("features")
    drawn = chosen.select(*columns).union(_distorted(chosen).select(*columns))
    drawn = write_through(drawn, "pii-training")
    half = (F.count(F.lit(1)) / 2).cast("long").alias("n")  # each candidate is there twice
    strata = drawn.groupBy("kind", "label").agg(F.max("draw").alias("last"), half).collect()
    if len({r["label"] for r in strata}) < 2:
        return None
    ensure_checkpoints(rows.sparkSession)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11, checkpointInterval=10, maxBins=32)
    model = trees.fit(drawn.select("label", array_to_vector("features").alias("features")).coalesce(8))
    used = reduce(
        lambda a, b: a | b,
        [(F.col("kind") == r["kind"]) & (F.col("label") == r["label"]) & (F.col("draw") <= r["last"]) for r in strata],
    )
    unseen = _distorted(known.filter((F.col("fold") == 0) | ~used))
    scored = model.transform(unseen.select("kind", "label", array_to_vector(features()).alias("features")))
    return model, _thresholds(scored, {(r["kind"], r["label"]): r["n"] for r in strata})


def score() -> Column:
    return F.get(vector_to_array("probability"), F.lit(1))


def _thresholds(scored: DataFrame, drawn: dict[tuple[int, float], int]) -> list[float]:
    """Per kind, the lowest of 19 steps from 0.5 up at which ``PRECISION`` is met; 2 (never) if there is none.

    A kind of which no true candidate is left over for this takes the step that holds for all kinds together.
    ``drawn`` says how many candidates of each kind and label are missing from ``scored``; those that are
    there stand for them too, since the draw takes other shares of true and false ones.
    """
    steps = [0.5 + i / 40 for i in range(19)]
    sums = [F.sum((score() >= s).cast("int")).alias(f"n{i}") for i, s in enumerate(steps)]
    counted = scored.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    by = {(r["kind"], r["label"]): r for r in counted}

    def reached(kind: int, label: float, i: int) -> float:
        row = by.get((kind, label))
        return row[f"n{i}"] * (row["n"] + drawn.get((kind, label), 0)) / row["n"] if row else 0.0

    def lowest(kinds: list[int]) -> float:
        sums = [[sum(reached(kind, label, i) for kind in kinds) for label in (1.0, 0.0)] for i in range(len(steps))]
        return min((s for s, (true, false) in zip(steps, sums) if true and true >= PRECISION * (true + false)), default=2.0)

    every = list(range(len(KINDS)))
    return [lowest([kind] if (kind, 1.0) in by else every) for kind in every]


def _keys() -> list[Column]:
    """What names a text: its id and a hash; rows that repeat both have the same spans."""
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k"), F.xxhash64(text).alias("h")]


def _accepted(rows: DataFrame, most: int) -> DataFrame:
    """Spans that the trees add: (k, h, added). Of accepted ones that overlap, the surest stays."""
    learned = fit(rows, most)
    # What fails the check of its kind is settled, and so is what a base span covers.
    open_ = rows.filter(F.col("label").isNull() & ~_overlaps(F.col("base")))
    if learned is None:
        return open_.filter("false").select("k", "h", F.array(F.struct("kind", "start", "end")).alias("added"))
    model, thresholds = learned
    limit = F.get(F.array(*[F.lit(t) for t in thresholds]), F.col("kind"))
    scored = model.transform(open_.withColumn("features", array_to_vector(features())))
    taken = scored.withColumn("score", score()).filter(F.col("score") >= limit)
    best_first = F.sort_array(F.collect_set(F.struct(-F.col("score"), (F.col("start") - F.col("end")).alias("size"), "kind", "start", "end")))
    none = F.array().cast(f"array<{SPAN}>")

    def keep(acc: Column, s: Column) -> Column:
        clash = F.exists(acc, lambda a: (a["kind"] == s["kind"]) & (a["start"] < s["end"]) & (a["end"] > s["start"]))
        return F.when(clash, acc).otherwise(F.concat(acc, F.array(F.struct(s["kind"], s["start"], s["end"]))))

    return taken.groupBy("k", "h").agg(F.aggregate(best_first, none, keep).alias("added"))


def found_spans(docs: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): k, h, doc_id, base spans and all spans.

    Spans are (kind number, start, end) in code points, by kind, then start. Null texts are empty and
    have none; rows with one id and text get the same spans; an empty table gives no rows. Texts are
    read once and whole, and only narrow rows are written and joined.
    """
    text = F.coalesce("text", F.lit(""))
    seen = docs.select("doc_id", *_keys(), base_spans(text).alias("base"), candidates(text).alias("proposed"))
    seen = write_through(seen, "pii-candidates")
    rows = _labelled(seen.select("k", "h", "base", F.explode("proposed").alias("c")).select("k", "h", "base", "c.*"))
    added = _accepted(rows, most)
    joined = seen.select("doc_id", "k", "h", "base").join(added, ["k", "h"], "left")
    both = F.array_sort(F.concat("base", F.coalesce("added", F.slice("base", 1, 0))))
    return joined.select("k", "h", "doc_id", "base", both.alias("spans"))


def named(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(
        F.col(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(docs: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with every span of every text replaced by its kind in brackets; other columns stay as they are.

    Overlapping spans become one, named after the kind that comes first. A null text stays null.
    """
    spans = found_spans(docs.select("doc_id", "text"), most).filter(F.size("spans") > 0)
    spans = spans.groupBy("k", "h").agg(F.first("spans").alias("spans"))
    by_place = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("row.text"), acc["at"] + 1, s["start"] - acc["at"])
        more = F.concat(acc["text"], gap, F.get(names, s["kind"]))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.when(fresh, more).otherwise(acc["text"]).alias("text"), F.greatest(acc["at"], s["end"]).alias("at")
        )

    done = F.aggregate(by_place, start, step)
    rest = F.substring(F.col("row.text"), done["at"] + 1, F.length("row.text"))
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.concat(done["text"], rest))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    joined = docs.select(*_keys(), row).join(spans.hint("shuffle_hash"), ["k", "h"], "left")
    return joined.withColumn("row", F.col("row").withField("text", text)).select("row.*")
