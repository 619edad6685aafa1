"""Quality rules by weak supervision: rules vote or abstain, and EM weighs them by how well they agree.

A rule says good (+1), bad (-1) or nothing (0). Nobody knows the true class of a document, so the
accuracy of each rule is estimated together with it: documents are summed up by their pattern of
votes, and expectation-maximisation over these sums gives accuracies and, for each pattern, the
probability that its documents are good.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.session import write_through

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
# Common short words of English, French, German and Spanish.
FUNCTION_WORDS = frozenset(
    "the of and to in a is it for on with as that this by be are was at from or an he not "
    "le la les de des du et un une en que qui dans pour pas sur au par est avec "
    "der die das und ein eine zu von den dem im mit ist nicht auf für sich als auch "
    "el los las y del se por con una para lo su es como".split()
)
FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_function long, n_alpha long, n_marks long, n_bare long, n_foreign long"
)
FOREIGN = re.compile("[^\\W\\d_\u0000-\u024f]")  # letters that no Latin alphabet has


def repeated_words(words: list) -> int:
    """How many words stand in a window of three that occurs twice or more."""
    if len(words) < 4:
        return 0
    index: dict = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    kinds = len(index)
    if kinds == len(words):
        return 0
    pairs = ids[:-2] * kinds + ids[1:-1]
    if kinds > 2_000_000:  # three ids no longer fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * kinds + ids[2:]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The counts behind the rules, over the whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # exactly the six ASCII blanks separate words
    lines = [line for line in raw.split(b"\n") if line.split()]
    spaces = len(raw) - sum(map(len, words))
    plain = [w.decode() for w in words]
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(str.isupper, plain)),
        sum(w.strip(".,;:!?").lower() in FUNCTION_WORDS for w in plain),
        sum(map(str.isalpha, text)),
        text.count("!") + text.count("?"),
        sum(len(w) == 1 and not w.isalnum() for w in plain),
        0 if text.isascii() else len(FOREIGN.findall(text)),
    )


def features(text: str) -> Column:
    """The struct of measured counts of a text column."""
    names = [part.split()[0] for part in FEATURES.split(",")]

    @F.pandas_udf(FEATURES)
    def counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=names).astype("int64")

    return counts(F.col(text))


def _bad_if(bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).otherwise(F.lit(0))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def votes(f: str) -> list[Column]:
    """What each rule says of a struct of measured counts.

    A rule that looks for one kind of junk abstains where it finds none, since that says little of
    the other kinds. Only rules on what prose has can vote good. The rule on common words knows languages in
    Latin letters, which share many of them; on texts mostly in other letters it abstains.
    """
    col = lambda name: F.col(f"{f}.{name}")
    words = F.greatest(col("n_words"), F.lit(1))
    share = lambda name: col(name) / words
    spoken = F.greatest(col("n_words") - col("n_bare"), F.lit(1))
    chars = (col("word_chars") - col("n_symbols")) / spoken
    lines = col("n_dup_lines") / F.greatest(col("n_lines"), F.lit(1))
    alpha = col("n_alpha") / F.greatest(col("word_chars"), F.lit(1))
    return [
        _bad_if(share("n_symbols") > 0.1),
        _bad_if(share("n_repeat_words") > 0.4),
        _bad_if(share("n_upper") > 0.3),
        _bad_if(lines > 0.4),
        _bad_if(share("n_marks") > 0.3),
        _bad_if(share("n_bare") > 0.2),
        _vote((chars < 3.0) | (chars > 10.0), chars.between(4.0, 6.5)),
        _vote((share("n_function") < 0.02) & (2 * col("n_foreign") <= col("n_alpha")), share("n_function") > 0.08),
        _vote(alpha < 0.8, alpha > 0.92),
    ]


def pattern(f: str) -> Column:
    """All votes as one number in base three."""
    code = F.lit(0)
    for vote in votes(f):
        code = code * 3 + (vote + 1)
    return code.cast("int")


@dataclass(frozen=True)
class RuleModel:
    accuracy: np.ndarray  # of each rule when it does not abstain
    prior: float  # share of good documents
    posterior: np.ndarray  # P(good) for each of the 3^rules patterns

    def quality(self, code: Column) -> Column:
        """P(good) of a pattern, from a table whose size the number of rules sets."""
        table = self.posterior

        @F.pandas_udf("double")
        def look_up(codes: pd.Series) -> pd.Series:
            return pd.Series(table[codes.to_numpy()])

        return look_up(code)


def _signs(rules: int) -> np.ndarray:
    codes = np.arange(3**rules)
    return np.stack([codes // 3 ** (rules - 1 - j) % 3 - 1 for j in range(rules)], axis=1)


def fit_rules(counts: dict[int, int], rules: int, rounds: int = 200) -> RuleModel:
    """EM over pattern counts. Accuracies stay within [0.6, 0.99], so a rule is never read upside down.

    Starts from accuracy 0.8 and even classes. No documents at all leave it there.
    """
    signs = _signs(rules)
    weight = np.zeros(len(signs))
    for code, n in counts.items():
        weight[code] = n
    accuracy, prior = np.full(rules, 0.8), 0.5
    for _ in range(rounds):
        odds = np.log(accuracy / (1 - accuracy))
        good = 1 / (1 + np.exp(-(signs @ odds + np.log(prior / (1 - prior)))))
        if not weight.sum():
            break
        right = np.where(signs > 0, good[:, None], 1 - good[:, None])
        said = weight[:, None] * (signs != 0)
        total = said.sum(0)
        new = np.clip(np.where(total > 0, (said * right).sum(0) / np.maximum(total, 1), 0.8), 0.6, 0.99)
        share = float(np.clip((weight * good).sum() / weight.sum(), 0.05, 0.95))
        still = max(np.abs(new - accuracy).max(), abs(share - prior))
        accuracy, prior = new, share
        if still < 1e-9:
            break
    return RuleModel(accuracy, prior, good)


def learn_rules(measured: DataFrame) -> RuleModel:
    """Fit on all rows of a table with the struct column ``f``."""
    return fit_rules(pattern_counts(measured), len(votes("f")))


def pattern_counts(measured: DataFrame) -> dict[int, int]:
    """How many rows have each pattern of votes: at most 3^rules sums reach the driver."""
    rows = measured.groupBy(pattern("f").alias("code")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["code"]: r["n"] for r in rows}


def base_failed(f: str = "f") -> Column:
    words = F.col(f"{f}.n_words")
    return (words < MIN_WORDS) | (100 * F.col(f"{f}.n_repeat_words") > 50 * words)


def judged(measured: DataFrame, model: RuleModel, threshold: float = 0.5) -> DataFrame:
    """Add base_failed, quality (the posterior) and kept to a table with the struct column ``f``."""
    return (
        measured.withColumn("base_failed", base_failed())
        .withColumn("quality", model.quality(pattern("f")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the counts, base_failed, quality and kept.

    Null and empty texts have no words and fail the base rule. Rows that repeat are measured each
    for themselves; an empty table gives no rows. Other columns are not read.
    """
    measured = write_through(docs.select("doc_id", features("text").alias("f")), "rule-counts")
    return judged(measured, learn_rules(measured)).select("doc_id", "f.*", "base_failed", "quality", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns and nothing else.

    The texts are measured twice, once to learn and once to filter; that needs no disk, where a copy of all
    rows with their verdicts, or a shuffle of them to meet these, takes as much as the table. Which patterns
    of votes are good is told by a list of those that occur, so the filter needs no further Python.
    """
    counts = pattern_counts(docs.select(features("text").alias("f")))
    model = fit_rules(counts, len(votes("f")))
    good = [code for code in sorted(counts) if model.posterior[code] >= 0.5]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    measured = docs.select(row, features("text").alias("f"))
    return measured.filter(~base_failed() & pattern("f").isin(good)).select("row.*")
