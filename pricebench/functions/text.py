"""Column functions that give the same text as the string methods listings were cleaned with."""

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebench.schemas import MAX_FIELD_CHARS, NOISE_DETAILS

# The characters str.strip removes, and Java spellings of Python's \w.
SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"[\p{L}\p{N}_]"
TOKEN = r"[\p{L}\p{N}_]{2,}"
# The length check comes first: it fails at once on most characters.
PART_NUMBER = (
    rf"(?d)(?=[A-Z0-9]{{7,}}(?!{WORD}))(?<!{WORD})(?=.*[A-Z])(?=.*\p{{Nd}})[A-Z0-9]+"
)
FLOAT = r"(?i)\A[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)\z"
NUMBER_IN_REPLY = r"[-+]?[0-9]*\.[0-9]+|[0-9]+"


def strip(text: Column) -> Column:
    """Remove all Unicode whitespace at both ends (``trim`` only knows the space)."""
    return F.btrim(text, F.lit(SPACE))


def flatten(text: Column, limit: int = MAX_FIELD_CHARS) -> Column:
    """One line of text: newlines to spaces, tabs and returns deleted, spaces collapsed."""
    for raw, flat in (("\n", " "), ("\r", ""), ("\t", "")):
        text = F.replace(text, F.lit(raw), F.lit(flat))
    return F.substring(strip(F.regexp_replace(text, " {2,}", " ")), 1, limit)


def strip_part_numbers(text: Column) -> Column:
    """Delete words of 7+ capitals and digits; the rest of the line must hold one of each.

    The two lookaheads scan from the word to the end of its line, not just the word.
    """
    return F.regexp_replace(text, PART_NUMBER, "")


def python_float(text: Column) -> Column:
    """``float(text)`` for ASCII input, null where that raises.

    The guard is needed because a cast also takes Java suffixes ('5d'). Underscores count
    only between digits.
    """
    bare = strip(text)
    misplaced = bare.rlike(r"(?:\A|[^0-9])_|_(?:\z|[^0-9])")
    digits = F.replace(bare, F.lit("_"), F.lit(""))
    return F.when(~misplaced & digits.rlike(FLOAT), digits.try_cast("double"))


def to_price(reply: Column) -> Column:
    """First number in a reply such as '$1,249.99'; 0.0 when there is none."""
    bare = F.regexp_replace(reply, "[$,]", "")
    found = F.regexp_extract(bare, NUMBER_IN_REPLY, 0)
    return F.coalesce(found.try_cast("double"), F.lit(0.0))


def or_null(text: Column) -> Column:
    """Null for an empty string, so that ``coalesce`` falls through it."""
    return F.nullif(text, F.lit(""))


# Lists and details are rendered by built-in expressions where the text is plain. Only the
# rows with unusual characters or nested JSON reach Python; all others send it a null.
# The functions are marked nondeterministic so that a filter on their result is not pushed
# below them, which would run Python (and all the text work around it) twice.

# Beyond ASCII and then not a letter, mark, number or sign: shown as an escape.
_UNUSUAL = r"[^\x20-\x7E\n\r\t](?<![\p{L}\p{M}\p{N}\p{P}\p{S}])"


def _quoted(element: Column) -> Column:
    escaped = F.replace(element, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    double = F.contains(element, F.lit("'")) & ~F.contains(element, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    shown = F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(single)
    return F.coalesce(shown, F.lit("None"))


def _python_list_text() -> Callable[[Column], Column]:
    # Nested, so that it is sent to the executors whole and this package need not be there.
    def render(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: None if x is None else str(list(x)))

    return F.pandas_udf(render, T.StringType()).asNondeterministic()


def list_text(elements: Column) -> Column:
    """The text Python shows for a list of strings: ``['a', "it's"]``."""
    unusual = F.array_join(elements, "\n").rlike(_UNUSUAL)
    built_in = F.concat(F.lit("["), F.array_join(F.transform(elements, _quoted), ", "), F.lit("]"))
    by_python = _python_list_text()(F.when(unusual, elements))
    return F.when(elements.isNotNull(), F.coalesce(by_python, built_in))


_DETAILS = "map<string,string>"
_LOADED = T.StructType([T.StructField("full", T.StringType()), T.StructField("kept", T.StringType())])


def _python_details() -> Callable[[Column], Column]:
    noise = NOISE_DETAILS

    def load(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            try:
                value = json.loads(text) if text is not None else None
            except (ValueError, RecursionError):
                value = None
            if isinstance(value, dict):
                kept = {key: v for key, v in value.items() if key not in noise}
                rows.append((json.dumps(value), json.dumps(kept) if kept else None))
            else:
                rows.append((None, None))
        return pd.DataFrame(rows, columns=["full", "kept"])

    return F.pandas_udf(load, _LOADED).asNondeterministic()


def _dump(details: Column) -> Column:
    pair = lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), e["value"], F.lit('"'))
    pairs = F.transform(F.map_entries(details), pair)
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def drop_noise(details: Column) -> Column:
    return F.map_filter(details, lambda key, _: ~key.isin(*NOISE_DETAILS))


def with_details(df: DataFrame, raw: str = "details") -> DataFrame:
    """Add ``details_map`` (empty on bad input) and ``details_text`` (kept keys as JSON, or null).

    A flat object of plain ASCII strings is recognised by rendering to exactly the text it
    was read from; its keys are dropped and printed by built-in expressions. Each step is
    a projection of its own, so that the text is parsed once.
    """
    flat = df.withColumn("_flat", F.from_json(raw, _DETAILS))
    keys = F.map_keys("_flat")
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    plain = (_dump(F.col("_flat")) == F.col(raw)) & ~F.col(raw).rlike(r"[^\x20-\x7E]") & unique
    checked = flat.withColumn("_plain", F.coalesce(plain, F.lit(False)))
    loaded = checked.withColumn("_loaded", _python_details()(F.when(~F.col("_plain"), F.col(raw))))
    kept = loaded.withColumn("_kept", drop_noise(F.col("_flat")))
    empty = F.from_json(F.lit("{}"), _DETAILS)
    text = F.when(F.size("_kept") > 0, _dump(F.col("_kept")))
    return kept.withColumns(
        {
            "details_map": F.coalesce(
                F.when(F.col("_plain"), F.col("_flat")), F.from_json("_loaded.full", _DETAILS), empty
            ),
            "details_text": F.when(F.col("_plain"), text).otherwise(F.col("_loaded.kept")),
        }
    ).drop("_flat", "_plain", "_loaded", "_kept")
