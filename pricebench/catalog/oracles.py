"""DuckDB SQL for the queries, over the same given tables.

Written apart from the Spark code: global windows and joins as SQL states them, with no
regard for scale.
"""

from pricebench.catalog.views import BOW_TERMS, CATEGORIES, DAMPING, STOP_WORDS, TFIDF_TERMS, WITHHELD
from pricebench.operators.requests import PRICE_SYSTEM, SUMMARY_SYSTEM

W = r"[\p{L}\p{N}_]"
QUESTION = "What does this cost to the nearest dollar?"
NOISE = "('Part Number', 'Best Sellers Rank', 'Batteries Included?', 'Batteries Required?', 'Item model number')"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def hashed(seed: str, key: str) -> str:
    return f"('0x' || substr(md5('42:{seed}:' || {key}::VARCHAR), 1, 13))::BIGINT"


def strip(x: str) -> str:
    space = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
    return f"regexp_replace({x}, '^{space}+|{space}+$', '', 'g')"


def flatten(x: str) -> str:
    one_line = f"regexp_replace(translate({x}, chr(10) || chr(13) || chr(9), ' '), ' {{2,}}', ' ', 'g')"
    return f"substr({strip(one_line)}, 1, 3000)"


def number(x: str) -> str:
    bare = strip(x)
    digits = f"replace({bare}, '_', '')"
    guard = r"(?i)[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)"
    misplaced = f"regexp_matches({bare}, '(?:^|[^0-9])_|_(?:$|[^0-9])')"
    return f"CASE WHEN NOT {misplaced} AND regexp_full_match({digits}, '{guard}') THEN TRY_CAST({digits} AS DOUBLE) END"


def reply_price(x: str) -> str:
    found = rf"regexp_extract(regexp_replace({x}, '[$,]', '', 'g'), '[-+]?[0-9]*\.[0-9]+|[0-9]+')"
    return f"coalesce(TRY_CAST({found} AS DOUBLE), CAST(0 AS DOUBLE))"


def damping(category: str = "category") -> str:
    cases = " ".join(f"WHEN {text(k)} THEN CAST({v} AS DOUBLE)" for k, v in DAMPING.items())
    return f"CASE {category} {cases} ELSE CAST(1 AS DOUBLE) END"


TEXT = """coalesce(nullif(summary, ''), nullif("full", ''), title)"""

ITEMS = """openings AS (SELECT conv_id * 3 AS summed_id, min(text) AS said FROM conversations WHERE turn = 0 GROUP BY conv_id),
items AS (
SELECT d.doc_id AS id, e.event_type AS category, coalesce(p.p_name || ' ' || p.p_brand, 'untitled') AS title,
       e.value AS price, d.text AS "full",
       CASE WHEN d.doc_id % 4 <> 0 THEN CAST(e.user_id % 40 AS DOUBLE) / 8 END AS weight,
       CASE WHEN d.doc_id % 3 = 0 THEN o.said WHEN d.doc_id % 3 = 1 THEN '' END AS summary
FROM documents d JOIN events e ON d.doc_id = e.event_id LEFT JOIN part p ON d.doc_id = p.p_partkey
LEFT JOIN openings o ON d.doc_id = o.summed_id
WHERE e.value BETWEEN CAST(0.5 AS DOUBLE) AND CAST(999.49 AS DOUBLE))"""


def placed(source: str, key: str, name: str = "placed") -> str:
    """Split a table: ids over the seeded order, then train, validation, test."""
    return f"""{name}_ranked AS (
SELECT *, row_number() OVER (ORDER BY {hashed('split', key)}, {key}) - 1 AS new_id, count(*) OVER () AS total
FROM {source}),
{name} AS (
SELECT *, CASE WHEN new_id < total - least(10000, total // 10) - least(2000, total // 10) THEN 'train'
               WHEN new_id < total - least(2000, total // 10) THEN 'validation' ELSE 'test' END AS split
FROM {name}_ranked)"""


SPLIT = ITEMS + ",\n" + placed("items", "id")


def first_of(source: str, column: str, name: str, key: str = "id") -> str:
    return f"""{name} AS (
SELECT * EXCLUDE (rn) FROM (
SELECT *, row_number() OVER (PARTITION BY {column} ORDER BY {hashed('dedup', key)}, {key}) AS rn FROM {source})
WHERE rn = 1)"""


DEDUP = ITEMS + ",\n" + first_of("items", "title", "by_title") + ",\n" + first_of("by_title", '"full"', "kept")


def drawn(source: str, key: str, name: str = "drawn", size: int = 200) -> str:
    return f"""{name}_ends AS (SELECT min(price) AS low, max(price) AS high FROM {source}),
{name}_weighed AS (
SELECT s.*, pow((price - low) / (high - low + CAST(1e-9 AS DOUBLE)), 2) * {damping()} AS w
FROM {source} s, {name}_ends),
{name} AS (
SELECT * EXCLUDE (w) FROM {name}_weighed WHERE w > 0
ORDER BY -ln(({hashed('sample', key)} + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE)) / w, {key}
LIMIT {size})"""


LISTINGS = """listings AS (
SELECT d.doc_id AS src_id, e.event_type AS category, p.p_name || ' ' || p.p_brand AS title,
       CASE WHEN d.doc_id % 17 = 0 THEN NULL WHEN d.doc_id % 19 = 0 THEN ''
            WHEN d.doc_id % 23 = 0 THEN concat('$', CAST(CAST(e.value AS DECIMAL(10,2)) AS VARCHAR))
            ELSE CAST(CAST(e.value AS DECIMAL(10,2)) AS VARCHAR) END AS price,
       d.text AS description,
       string_split(d.text, chr(10)) AS features,
       CASE WHEN d.doc_id % 29 = 0 THEN '{bad' ELSE
         concat('{"Part Number": "', p.p_brand, '", "Color": "', p.p_type, '"',
           CASE p.p_partkey % 8 WHEN 7 THEN '' ELSE
             concat(', "Item Weight": "', CAST(p.p_size AS VARCHAR), ' ',
               CASE p.p_partkey % 8 WHEN 0 THEN 'Pounds' WHEN 1 THEN 'ounces' WHEN 2 THEN 'grams'
                 WHEN 3 THEN 'kilograms' WHEN 4 THEN 'milligrams' WHEN 5 THEN 'hundredths pounds'
                 ELSE 'stone' END, '"') END, '}') END AS details
FROM documents d JOIN events e ON d.doc_id = e.event_id JOIN part p ON d.doc_id = p.p_partkey)"""

# Details as rows: one per key of a valid object.
PAIRS = """pairs AS (
SELECT src_id, key, json_extract_string(details, '$."' || key || '"') AS value, position
FROM (SELECT src_id, details, unnest(json_keys(details)) AS key, generate_subscripts(json_keys(details), 1) AS position
      FROM listings WHERE json_valid(details)))"""


def details_text(keep: str) -> str:
    return f"""SELECT l.src_id, coalesce(string_agg(key || '=' || value, '|' ORDER BY key || '=' || value), '') AS details
FROM listings l LEFT JOIN (SELECT * FROM pairs WHERE {keep}) p ON l.src_id = p.src_id GROUP BY l.src_id"""


SHOWN = r"""replace(replace(replace(replace(x, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')"""


def shown(elements: str) -> str:
    """The text Python shows for a list of strings."""
    return f"""'[' || array_to_string(list_transform({elements}, lambda x:
CASE WHEN contains(x, '''') AND NOT contains(x, '"') THEN '"' || {SHOWN} || '"'
     ELSE '''' || replace({SHOWN}, '''', '\\''') || '''' END), ', ') || ']'"""


def bodies(description: str) -> str:
    return (
        LISTINGS
        + ",\n"
        + PAIRS
        + f""",
kept_text AS (
SELECT src_id, '{{' || string_agg('"' || key || '": "' || value || '"', ', ' ORDER BY position) || '}}' AS json
FROM pairs WHERE key NOT IN {NOISE} GROUP BY src_id),
bodies AS (
SELECT l.*, concat_ws(chr(10), title, {flatten(description)}, {flatten(shown('features'))}, json) AS body
FROM listings l LEFT JOIN kept_text k ON l.src_id = k.src_id)"""
    )


def stripped(source: str, key: str, column: str, name: str = "stripped") -> str:
    """Part numbers without lookahead.

    A word starts before the last capital and the last digit of its line exactly when it
    starts before the nearer of the two; the line is cut after the word holding that one.
    """
    mark = f"regexp_replace(substr(line, 1, stop), '({W}+)', chr(1) || '\\1' || chr(2), 'g')"
    gone = f"regexp_replace({mark}, '\\x01[A-Z0-9]{{7,}}\\x02', '', 'g')"
    return rf"""{name}_lines AS (
SELECT {key}, unnest(string_split({column}, chr(10))) AS line,
       generate_subscripts(string_split({column}, chr(10)), 1) AS position FROM {source}),
{name}_ends AS (
SELECT *, least(length(line) - length(regexp_extract(line, '[^A-Z]*$')),
                length(line) - length(regexp_extract(line, '[^\p{{Nd}}]*$'))) AS last FROM {name}_lines),
{name}_cuts AS (
SELECT *, last + length(regexp_extract(substr(line, last + 1), '^{W}*')) AS stop FROM {name}_ends),
{name} AS (
SELECT {key}, string_agg(CASE WHEN last = 0 THEN line
  ELSE regexp_replace({gone}, '[\x01\x02]', '', 'g') || substr(line, stop + 1) END, chr(10) ORDER BY position) AS clean
FROM {name}_cuts GROUP BY {key})"""


WEIGHTS = (
    PAIRS
    + f""",
weights AS (
SELECT l.src_id, coalesce(CASE
  WHEN lower(u[2]) = 'hundredths' AND lower(u[3]) = 'pounds' THEN ({number('u[1]')}) / 100
  ELSE ({number('u[1]')}) * CASE lower(u[2]) WHEN 'pounds' THEN CAST(1 AS DOUBLE)
    WHEN 'ounces' THEN CAST(1 AS DOUBLE) / 16 WHEN 'grams' THEN CAST(1 AS DOUBLE) / CAST(453.592 AS DOUBLE)
    WHEN 'milligrams' THEN CAST(1 AS DOUBLE) / 453592 WHEN 'kilograms' THEN CAST(1 AS DOUBLE) / CAST(0.453592 AS DOUBLE)
    ELSE CAST(0 AS DOUBLE) END END, CAST(0 AS DOUBLE)) AS weight
FROM listings l LEFT JOIN (SELECT src_id, string_split(value, ' ') AS u FROM pairs WHERE key = 'Item Weight') p
  ON l.src_id = p.src_id)"""
)

def parsed(description: str) -> str:
    return (
        bodies(description)
        + ",\n"
        + WEIGHTS.removeprefix(PAIRS + ",\n")
        + ",\n"
        + stripped("bodies", "src_id", "body")
        + f""",
parsed AS (
SELECT b.src_id, title, category, {number('price')} AS price, substr({strip('clean')}, 1, 4000) AS "full", weight
FROM bodies b JOIN stripped s ON b.src_id = s.src_id JOIN weights w ON b.src_id = w.src_id),
usable AS (
SELECT * FROM parsed WHERE price BETWEEN CAST(0.5 AS DOUBLE) AND CAST(999.49 AS DOUBLE) AND length("full") >= 600)"""
    )


BODIES = bodies("nullif(description, '')")
PARSED = parsed("nullif(description, '')")

PREDICTIONS = """predictions AS (
SELECT concat('m', CAST(m.k AS VARCHAR)) AS model, e.event_id AS id,
       concat(e.event_type, ' ', CAST(e.event_id AS VARCHAR)) AS title, e.value AS truth,
       e.value * CAST(5 + (e.event_id + m.k) % 11 AS DOUBLE) / CAST(10 AS DOUBLE)
       + CASE WHEN (e.event_id + m.k) % 13 = 0 THEN CAST(150 AS DOUBLE)
              WHEN (e.event_id + m.k) % 13 = 1 THEN CAST(60 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS guess
FROM events e CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 3 UNION ALL SELECT 7) m)"""

REPLIES = """replies AS (
SELECT event_id AS id, unnest(CASE WHEN event_id % 13 = 0 THEN [0, 1] ELSE [0] END) AS replied_at,
       unnest(CASE WHEN event_id % 13 = 0 THEN [said, 'again 7'] ELSE [said] END) AS reply,
       CAST(100 + event_id % 50 AS BIGINT) AS prompt_tokens,
       CAST(event_id % 12 AS BIGINT) AS completion_tokens,
       CASE WHEN event_id % 5 = 0 THEN NULL
            ELSE CAST(event_id % 9 AS DOUBLE) / CAST(10000 AS DOUBLE) END AS cost
FROM (SELECT *, CASE WHEN event_id % 22 = 0 THEN ' ' || chr(10) WHEN event_id % 22 = 11 THEN NULL
  ELSE CASE event_id % 7 WHEN 0 THEN concat('$', CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR))
         WHEN 1 THEN 'about $1,249.99 or so' WHEN 2 THEN 'I cannot say' WHEN 3 THEN '-5'
         WHEN 4 THEN '.99' WHEN 5 THEN ' 12 or 13 '
         ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END END AS said FROM events)),
answers AS (SELECT id, coalesce(arg_max(reply, replied_at) FILTER (WHERE trim(reply, ' ' || chr(10)) <> ''), '') AS reply
FROM replies WHERE reply IS NOT NULL GROUP BY id)"""


def scored(source: str) -> str:
    """Errors, bands and the metrics of long predictions."""
    return f"""errors AS (
SELECT *, abs(guess - truth) AS error,
       pow(ln(1 + greatest(guess, 0)) - ln(1 + truth), 2) AS log_error FROM {source}),
banded AS (
SELECT *, CASE WHEN error < 40 OR error / nullif(truth, 0) < CAST(0.2 AS DOUBLE) THEN 'green'
               WHEN error < 80 OR error / nullif(truth, 0) < CAST(0.4 AS DOUBLE) THEN 'amber' ELSE 'red' END AS band
FROM errors),
metrics AS (
SELECT model, count(*) AS n, round(avg(error), 6) AS avg_error, round(median(error), 6) AS median_error,
       round(sqrt(avg(log_error)), 6) AS rmsle,
       round(1 - sum(pow(truth - guess, 2)) / nullif(regr_sxx(truth, truth), 0), 6) AS r2,
       round(avg(CASE WHEN band = 'green' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS hit_rate
FROM banded GROUP BY model)"""


SCORED = PREDICTIONS + ",\n" + scored("predictions")

TOKENS = (
    ITEMS
    + rf""",
tokens AS (
SELECT id, term FROM (
SELECT id, unnest(regexp_extract_all(lower({TEXT}), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM items)
WHERE term NOT IN {listed(STOP_WORDS)}),
tf AS (SELECT id, term, count(*) AS n FROM tokens GROUP BY id, term),
terms AS (SELECT term, CAST(sum(n) AS BIGINT) AS n, count(*) AS documents FROM tf GROUP BY term),
ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, term) AS place FROM terms WHERE documents >= 2),
vocabulary AS (SELECT * FROM ranked WHERE place <= {BOW_TERMS}),
wide AS (SELECT * FROM ranked WHERE place <= {TFIDF_TERMS})"""
)


def slice_of(split: str, size: int, source: str = "placed") -> str:
    return f"""slice AS (
SELECT * FROM {source} WHERE split = '{split}'
  AND new_id < (SELECT min(new_id) FROM {source} WHERE split = '{split}') + {size})"""


def category_guess(train: str, to: str) -> str:
    return f"""means AS (SELECT category, avg(price) AS mean FROM {train} GROUP BY category),
scored_items AS (
SELECT t.*, coalesce(m.mean, (SELECT avg(price) FROM {train})) AS guess
FROM {to} t LEFT JOIN means m ON t.category = m.category)"""


TRAIN = "(SELECT * FROM placed WHERE split = 'train')"


def baselines(size: int, models: tuple[str, ...]) -> str:
    guesses = {
        "random guess": f"CAST({hashed('guess', 'new_id')} % 999 + 1 AS DOUBLE)",
        "training average": f"(SELECT avg(price) FROM {TRAIN})",
        "category average": "scored_items.guess",
    }
    rows = "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, new_id AS id, price AS truth, {guesses[m]} AS guess FROM scored_items" for m in models
    )
    return f"{slice_of('test', size)},\n{category_guess(TRAIN, 'slice')},\nscored_models AS (\n{rows})"


def least_squares(features: list[str], train: str, to: str) -> str:
    """Ordinary least squares by successive orthogonalisation.

    Each feature is reduced by its regressions on the ones before it; the coefficients come
    from the training rows and are applied to the others as well.
    """
    steps = [f"""ls0 AS (
SELECT 'fit' AS part, new_id, ln(1 + price) AS y, ln(1 + price) AS rest, CAST(0 AS DOUBLE) AS line,
       {', '.join(features)} FROM {train}
UNION ALL SELECT 'score', new_id, NULL, NULL, CAST(0 AS DOUBLE), {', '.join(features)} FROM {to}),
ls_mean AS (SELECT * REPLACE ((SELECT avg(y) FROM ls0 WHERE part = 'fit') AS line,
                              rest - (SELECT avg(y) FROM ls0 WHERE part = 'fit') AS rest,
  {', '.join(f"{f} - (SELECT avg({f}) FROM ls0 WHERE part = 'fit') AS {f}" for f in features)}) FROM ls0)"""]
    last = "ls_mean"
    for i, f in enumerate(features):
        slope = lambda y: f"(SELECT sum({y} * {f}) / sum({f} * {f}) FROM {last} WHERE part = 'fit')"
        later = [f"{g} - {f} * {slope(g)} AS {g}" for g in features[i + 1 :]]
        replaced = ", ".join([f"line + {f} * {slope('rest')} AS line", f"rest - {f} * {slope('rest')} AS rest", *later])
        steps.append(f"ls_{f} AS (SELECT * REPLACE ({replaced}) FROM {last})")
        last = f"ls_{f}"
    return ",\n".join(steps)


def sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


EVENT_METRICS = "model, n, avg_error, median_error, rmsle, r2, hit_rate"

ORACLES: dict[str, str] = {
    # Sources and sinks
    "read_listings": sql(
        LISTINGS,
        f"""SELECT category, title, price, description, CAST(len(features) AS BIGINT) AS n_features, details
FROM listings WHERE category IN {listed(CATEGORIES)}""",
    ),
    "union_categories": sql(
        LISTINGS, "SELECT category, title, price FROM listings"
    ),
    "read_splits": sql(
        SPLIT, 'SELECT new_id AS id, title, category, price, "full", weight, summary, split FROM placed'
    ),
    "write_splits": sql(
        SPLIT,
        """SELECT split, count(*) AS lines, count(*) AS no_prompt,
CAST(count(*) FILTER (summary IS NULL) AS BIGINT) AS no_summary FROM placed GROUP BY split""",
    ),
    "split_counts": sql(SPLIT, "SELECT split, count(*) AS n FROM placed GROUP BY split"),
    "validate_items": sql(
        LISTINGS,
        f"""SELECT src_id AS id, {number('price')} AS price,
CASE WHEN ({number('price')}) IS NULL THEN 'price missing or not double' ELSE '' END AS reason FROM listings""",
    ),
    "report_rows": sql(PREDICTIONS, "SELECT 'events' AS dataset, model, id, title, truth, guess FROM predictions"),
    "report_summary": sql(SCORED, f"SELECT 'events' AS dataset, {EVENT_METRICS} FROM metrics"),
    "scatter_points": sql(
        SCORED,
        """SELECT model, id, title, truth, guess, band,
CASE band WHEN 'green' THEN '#1b7f5c' WHEN 'amber' THEN '#c98500' ELSE '#b3261e' END AS colour,
max(greatest(truth, guess)) OVER (PARTITION BY model) AS top FROM banded""",
    ),
    # Parse and clean
    "parse_price": sql(
        LISTINGS, f"SELECT * FROM (SELECT src_id, {number('price')} AS price FROM listings) WHERE price IS NOT NULL"
    ),
    "price_filter": """SELECT event_id, value FROM events
WHERE value BETWEEN CAST(0.5 AS DOUBLE) AND CAST(999.49 AS DOUBLE)""",
    "parse_details": sql(LISTINGS + ",\n" + PAIRS, details_text("true")),
    "drop_detail_keys": sql(LISTINGS + ",\n" + PAIRS, details_text(f"key NOT IN {NOISE}")),
    "render_features": sql(LISTINGS, f"SELECT src_id, {shown('features')} AS features FROM listings"),
    "flatten_text": sql(LISTINGS, f"SELECT src_id, {flatten('description')} AS flat FROM listings"),
    "assemble_body": sql(BODIES, "SELECT src_id, body FROM bodies"),
    "strip_part_numbers": sql(
        stripped("documents", "doc_id", "text"), "SELECT doc_id, clean AS stripped FROM stripped"
    ),
    "truncate_body": f"SELECT doc_id, substr({strip('text')}, 1, 4000) AS cut FROM documents",
    "min_length_filter": "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE length(text) >= 600",
    "weight_in_pounds": sql(LISTINGS + ",\n" + WEIGHTS, "SELECT src_id, weight FROM weights"),
    "parse_listings": sql(PARSED, 'SELECT src_id, title, category, price, "full", weight FROM usable'),
    "parse_stream": sql(
        parsed(shown("[description]")), 'SELECT title, category, price, "full", weight FROM usable'
    ),
    "parse_yield": sql(
        PARSED,
        """SELECT l.category, count(*) AS listings, count(u.src_id) AS usable
FROM listings l LEFT JOIN usable u ON l.src_id = u.src_id GROUP BY l.category""",
    ),
    # Curation
    "seeded_order": sql(
        ITEMS, f"SELECT id, row_number() OVER (ORDER BY {hashed('dedup', 'id')}, id) - 1 AS position FROM items"
    ),
    "dedup_title": sql(ITEMS + ",\n" + first_of("items", "title", "kept"), "SELECT id, title FROM kept"),
    "dedup_body": sql(ITEMS + ",\n" + first_of("items", '"full"', "kept"), 'SELECT id, "full" FROM kept'),
    "deduplicate": sql(DEDUP, "SELECT id, category, title, price FROM kept"),
    "minmax_scale": sql(
        ITEMS + ",\nends AS (SELECT min(price) AS low, max(price) AS high FROM items)",
        """SELECT id, round((price - low) / (high - low + CAST(1e-9 AS DOUBLE)), 6) AS scaled FROM items, ends""",
    ),
    "sample_weights": sql(
        ITEMS
        + f""",
ends AS (SELECT min(price) AS low, max(price) AS high FROM items),
raw AS (SELECT id, pow((price - low) / (high - low + CAST(1e-9 AS DOUBLE)), 2) * {damping()} AS w FROM items, ends)""",
        "SELECT id, round(w / (SELECT sum(w) FROM raw), 9) AS sample_weight FROM raw",
    ),
    "balanced_sample": sql(DEDUP + ",\n" + drawn("kept", "id"), "SELECT id, category, price FROM drawn"),
    "sample_summary": sql(
        DEDUP + ",\n" + drawn("kept", "id"), "SELECT count(*) AS n, round(avg(price), 6) AS mean_price FROM drawn"
    ),
    "train_val_test_split": sql(SPLIT, "SELECT id AS source_id, new_id AS id, split FROM placed"),
    "sequential_ids": sql(
        ITEMS, f"SELECT id, row_number() OVER (ORDER BY {hashed('split', 'id')}, id) - 1 AS position FROM items"
    ),
    "describe_prices": sql(
        ITEMS,
        """SELECT count(*) AS n, round(avg(price), 6) AS mean_price, median(price) AS median_price,
min(price) AS min_price, max(price) AS max_price FROM items""",
    ),
    "category_histogram": sql(ITEMS, "SELECT category, count(*) AS n FROM items GROUP BY category"),
    "curate": sql(
        ",\n".join(
            [
                PARSED,
                first_of("usable", "title", "by_title", "src_id"),
                first_of("by_title", '"full"', "kept", "src_id"),
                drawn("kept", "src_id"),
                placed("drawn", "src_id"),
            ]
        ),
        'SELECT src_id, title, category, price, "full", weight, new_id AS id, split FROM placed',
    ),
    # Items
    "item_text": sql(ITEMS, f"SELECT id, {TEXT} AS text FROM items"),
    "training_prompts": sql(
        ITEMS,
        f"""SELECT id, '{QUESTION}' || chr(10) || chr(10) || {TEXT} || chr(10) || chr(10) || 'Price is $'
|| CAST(CAST(round_even(price, 0) AS BIGINT) AS VARCHAR) || '.00' AS prompt FROM items""",
    ),
    "inference_prompts": sql(
        ITEMS,
        f"""SELECT id, '{QUESTION}' || chr(10) || chr(10) || {TEXT} || chr(10) || chr(10) || 'Price is $' AS prompt
FROM items""",
    ),
    "text_to_items": """SELECT doc_id, substr(text, 1, 60) AS title, 'unknown' AS category, CAST(0 AS DOUBLE) AS price,
text AS "full" FROM documents""",
    # Features
    "token_counts": sql(TOKENS, "SELECT term, n, documents FROM terms"),
    "vocabulary": sql(TOKENS, "SELECT term, n, documents FROM vocabulary"),
    "bow_counts": sql(TOKENS, "SELECT tf.id, tf.term, tf.n FROM tf JOIN vocabulary v ON tf.term = v.term"),
    "tfidf": sql(
        TOKENS
        + """,
weighted AS (
SELECT tf.id, tf.term,
       tf.n * (ln(CAST(1 + (SELECT count(*) FROM items) AS DOUBLE) / (1 + v.documents)) + 1) AS w
FROM tf JOIN wide v ON tf.term = v.term)""",
        "SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS tfidf FROM weighted",
    ),
    "hashed_features": sql(
        TOKENS
        + """,
hashed AS (SELECT DISTINCT id, CAST(CAST(concat('0x', substr(md5(term), 1, 8)) AS BIGINT) % 5000 AS INTEGER) AS bucket
FROM tokens)""",
        """SELECT id, bucket, round(CAST(1 AS DOUBLE) / sqrt(count(*) OVER (PARTITION BY id)), 6) AS value FROM hashed""",
    ),
    "hand_features": sql(
        ITEMS,
        f"""SELECT id, coalesce(weight, CAST(0 AS DOUBLE)) AS weight,
CAST(coalesce(weight, 0) = 0 AS BIGINT) AS weight_missing, CAST(length({TEXT}) AS BIGINT) AS text_length,
CAST(length({TEXT}) - length(replace({TEXT}, ' ', '')) + 1 AS BIGINT) AS word_count FROM items""",
    ),
    "log_target": sql(ITEMS, "SELECT id, round(ln(1 + price), 6) AS target FROM items"),
    "inverse_target": sql(
        ITEMS,
        """SELECT id, round(greatest(exp(ln(1 + price) - 1) - 1, CAST(0.5 AS DOUBLE)), 6) AS classical,
round(greatest(exp(ln(1 + price) - 1) - 1, CAST(0 AS DOUBLE)), 6) AS hashed FROM items""",
    ),
    "standardise_target": sql(
        ITEMS + ",\nm AS (SELECT avg(ln(1 + price)) AS mean, stddev_samp(ln(1 + price)) AS sd FROM items)",
        "SELECT id, round((ln(1 + price) - mean) / sd, 6) AS scaled FROM items, m",
    ),
    "train_cap": sql(
        SPLIT, "SELECT new_id AS id, id AS source_id, price FROM placed WHERE split = 'train' AND new_id < 300"
    ),
    # Models
    "model_random": sql(ITEMS, f"SELECT id, CAST({hashed('guess', 'id')} % 999 + 1 AS DOUBLE) AS guess FROM items"),
    "model_average": sql(
        SPLIT,
        f"SELECT new_id AS id, round((SELECT avg(price) FROM {TRAIN}), 6) AS guess FROM placed WHERE split = 'test'",
    ),
    "model_category_average": sql(
        SPLIT
        + f",\ntrain AS (SELECT * FROM placed WHERE split = 'train' AND category <> '{WITHHELD}'),\n"
        + category_guess("train", "items"),
        "SELECT id, category, round(guess, 6) AS guess FROM scored_items",
    ),
    "model_features": sql(
        SPLIT
        + f""",
hand AS (
SELECT *, coalesce(weight, CAST(0 AS DOUBLE)) AS f_weight,
       CASE WHEN coalesce(weight, 0) = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS f_missing,
       CAST(length({TEXT}) AS DOUBLE) AS f_length,
       CAST(length({TEXT}) - length(replace({TEXT}, ' ', '')) + 1 AS DOUBLE) AS f_words FROM placed),
"""
        + least_squares(
            ["f_weight", "f_missing", "f_length", "f_words"],
            "(SELECT * FROM hand WHERE split = 'train')",
            "(SELECT * FROM hand WHERE split = 'test')",
        ),
        """SELECT 'linear (features)' AS model, s.new_id AS id, p.price AS truth,
round(greatest(exp(s.line) - 1, CAST(0.5 AS DOUBLE)), 4) AS guess
FROM ls_f_words s JOIN placed p ON s.new_id = p.new_id WHERE s.part = 'score'""",
    ),
    "zero_shot_requests": sql(
        ITEMS,
        f"""SELECT id, {text(PRICE_SYSTEM)} AS system,
'How much does this cost, to the nearest dollar?' || chr(10) || chr(10) || {TEXT} AS user,
CAST(0 AS DOUBLE) AS temperature, CAST(12 AS BIGINT) AS max_tokens FROM items""",
    ),
    "price_replies": sql(
        ITEMS + ",\n" + REPLIES,
        f"""SELECT i.id, i.price, greatest({reply_price('r.reply')}, CAST(0 AS DOUBLE)) AS guess
FROM items i LEFT JOIN answers r ON i.id = r.id""",
    ),
    "validation_mae": sql(
        SPLIT + ",\n" + slice_of("validation", 2000) + ",\n" + category_guess(TRAIN, "slice"),
        "SELECT round(avg(abs(guess - price)), 6) AS mae FROM scored_items",
    ),
    "score_texts": sql(
        SPLIT,
        f"""SELECT doc_id, substr(text, 1, 60) AS title, round((SELECT avg(price) FROM {TRAIN}), 6) AS guess
FROM documents""",
    ),
    # Summaries
    "summary_requests": sql(
        ITEMS + ",\n" + REPLIES,
        f"""SELECT id, {text(SUMMARY_SYSTEM)} AS system, coalesce(nullif("full", ''), title) AS user FROM items
WHERE coalesce(summary, '') = '' AND id NOT IN (SELECT id FROM answers WHERE id % 2 = 0 AND reply <> '')""",
    ),
    "summary_requests_first": sql(
        SPLIT
        + """,
firsts AS (SELECT split AS part, min(new_id) AS start FROM placed GROUP BY split)""",
        """SELECT new_id AS id, coalesce(nullif("full", ''), title) AS user FROM placed JOIN firsts ON split = part
WHERE coalesce(summary, '') = '' AND new_id < start + 250""",
    ),
    "apply_summaries": sql(
        ITEMS + ",\n" + REPLIES,
        f"""SELECT i.id, coalesce(nullif(i.summary, ''), {strip('r.reply')}, i.summary) AS summary
FROM items i LEFT JOIN answers r ON i.id = r.id""",
    ),
    "summary_usage": sql(
        REPLIES,
        """SELECT CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, round(sum(coalesce(cost, 0)), 6) AS cost FROM replies""",
    ),
    # Evaluation
    "to_price": sql(REPLIES, f"SELECT id, {reply_price('reply')} AS price FROM replies"),
    "prediction_errors": sql(
        SCORED, "SELECT model, id, error, round(log_error, 6) AS squared_log_error FROM banded"
    ),
    "error_bands": sql(SCORED, "SELECT model, id, band FROM banded"),
    "metrics": sql(SCORED, f"SELECT {EVENT_METRICS} FROM metrics"),
    "worst_misses": sql(
        SCORED,
        """SELECT model, id, title, truth, guess, error, place FROM (
SELECT *, row_number() OVER (PARTITION BY model ORDER BY error DESC, id) AS place FROM banded) WHERE place <= 5""",
    ),
    "band_counts": sql(
        SCORED,
        """SELECT model, count(*) FILTER (band = 'green') AS green, count(*) FILTER (band = 'amber') AS amber,
count(*) FILTER (band = 'red') AS red, count(*) AS total FROM banded GROUP BY model""",
    ),
    "leaderboard": sql(SCORED, f"SELECT {EVENT_METRICS} FROM metrics"),
    "leaderboard_display": sql(
        SCORED,
        """SELECT model, n, format('{:,.2f}', avg_error) AS avg_error, format('{:,.2f}', median_error) AS median_error,
format('{:.3f}', rmsle) AS rmsle, format('{:.3f}', r2) AS r2, format('{:.1f}%', hit_rate * 100) AS hit_rate FROM metrics""",
    ),
    "evaluation_slice": sql(
        SPLIT + ",\n" + slice_of("test", 250),
        "SELECT new_id AS id, id AS source_id, substr(title, 1, 40) AS title, price FROM slice",
    ),
    "test_sample_stats": sql(
        SPLIT + ",\n" + slice_of("test", 250),
        "SELECT count(*) AS n, round(avg(price), 6) AS mean_price, median(price) AS median_price FROM slice",
    ),
    "compare_models": sql(
        ",\n".join(
            [SPLIT, baselines(250, ("random guess", "training average", "category average")), scored("scored_models")]
        ),
        f"SELECT {EVENT_METRICS} FROM metrics",
    ),
    "flagship": sql(
        ",\n".join(
            [
                DEDUP,
                drawn("kept", "id"),
                placed("drawn", "id"),
                baselines(250, ("training average", "category average")),
                scored("scored_models"),
            ]
        ),
        f"SELECT {EVENT_METRICS} FROM metrics",
    ),
}
ORACLES["model_roundtrip"] = ORACLES["model_features"]  # what is read back must guess what was fitted
