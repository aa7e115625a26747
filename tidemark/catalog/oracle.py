"""ANSI SQL with the same results as the queries, for DuckDB."""

from __future__ import annotations

from tidemark.functions.text import ASCII_PUNCTUATION, EDGE_MARKS, STOP_WORDS

ORACLE: dict[str, str] = {}


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Trip records

TRIPS = """trips AS (
  SELECT l_partkey::VARCHAR AS taxi, l_suppkey::VARCHAR AS driver,
         strftime(l_shipdate, '%Y-%m-%d') || ' ' || lpad((l_orderkey % 24)::VARCHAR, 2, '0') || ':15:00' AS pickup,
         ((l_quantity % 50) * 100)::BIGINT::DOUBLE AS duration, l_quantity AS distance,
         l_extendedprice / 1000 AS fare, l_discount AS surcharge, l_tax * 100 AS tolls, l_extendedprice AS amount
  FROM lineitem WHERE l_linenumber <> 7 AND NOT (l_returnflag = 'R' AND l_linenumber = 6))"""
TRIP_COLUMNS = "taxi, driver, pickup, duration, distance, fare, surcharge, tolls, amount"
REGULAR = (
    "duration BETWEEN 120 AND 3600 AND fare BETWEEN 3 AND 200 AND distance BETWEEN 1 AND 50 AND tolls >= 3"
)

ORACLE["clean_trips"] = _with(TRIPS) + f"SELECT {TRIP_COLUMNS} FROM trips"
ORACLE["regular_trips"] = _with(TRIPS) + (
    f"SELECT {TRIP_COLUMNS}, duration::BIGINT AS duration_seconds FROM trips WHERE {REGULAR}"
)
ORACLE["number_check"] = """
SELECT CASE WHEN l_linenumber = 7 THEN 16 ELSE 17 END::BIGINT AS n_fields,
       NOT (l_returnflag = 'R' AND l_linenumber = 6) AS numeric_distance, count(*) AS n
FROM lineitem GROUP BY 1, 2"""
ORACLE["topk_count"] = _with(TRIPS) + (
    "SELECT taxi, count(*) AS trips FROM trips GROUP BY taxi ORDER BY 2 DESC, taxi LIMIT 10"
)
ORACLE["trip_files"] = ORACLE["topk_count"]
ORACLE["bottomk_count"] = _with(TRIPS) + (
    "SELECT taxi, count(*) AS trips FROM trips GROUP BY taxi ORDER BY 2, taxi LIMIT 10"
)
ORACLE["topk_driver_rate"] = _with(TRIPS) + """
SELECT driver, round(rate, 6) AS per_minute FROM (
  SELECT driver, sum(amount) / sum(duration) * 60 AS rate FROM trips
  WHERE duration <> 0 AND amount <> 0 GROUP BY driver ORDER BY 2 DESC, driver LIMIT 10)"""
ORACLE["topk_ratio_by_key"] = """
SELECT l_suppkey, round(rate, 6) AS per_minute FROM (
  SELECT l_suppkey, sum(l_extendedprice) / sum(l_quantity) * 60 AS rate FROM lineitem
  WHERE l_quantity <> 0 AND l_extendedprice <> 0 GROUP BY l_suppkey ORDER BY 2 DESC, l_suppkey LIMIT 10)"""
ORACLE["topk_hour_ratio"] = _with(TRIPS) + """
SELECT hour, round(r, 9) AS ratio FROM (
  SELECT substr(pickup, 12, 2) AS hour, sum(surcharge) / sum(distance) AS r FROM trips
  WHERE duration <> 0 AND amount <> 0 AND distance <> 0 AND surcharge <> 0
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"""
ORACLE["event_hour_ratio"] = """
SELECT hour, round(r, 9) AS ratio FROM (
  SELECT strftime(ts, '%H') AS hour, sum(value) / count(*) AS r FROM events
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"""
ORACLE["lines_round_trip"] = (
    "SELECT event_type, 3::BIGINT AS n_fields, count(*) AS n FROM events GROUP BY event_type"
)

# Linear regression

ORACLE["line_sums"] = """
SELECT count(*) AS n, round(sum(l_quantity), 2) AS sum_x, round(sum(l_extendedprice), 2) AS sum_y,
       round(sum(l_quantity * l_quantity), 2) AS sum_xx, round(sum(l_quantity * l_extendedprice), 2) AS sum_xy
FROM lineitem"""
ORACLE["ols_line"] = """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS m,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS b, count(*) AS n FROM lineitem"""
ORACLE["ols_trip_line"] = _with(TRIPS) + f"""
SELECT round(regr_slope(fare, distance), 6) AS m, round(regr_intercept(fare, distance), 6) AS b, count(*) AS n
FROM trips WHERE {REGULAR}"""

XS = {
    "quantity": "l_quantity / 50",
    "discount": "l_discount * 10",
    "tax": "l_tax * 10",
    "line": "l_linenumber / 7.0::DOUBLE",
}


def _items(xs: list[str]) -> str:
    scaled = ", ".join(f"{XS[x]} AS x{i}" for i, x in enumerate(xs))
    return f"items AS (SELECT {scaled}, l_extendedprice / 100000 AS y FROM lineitem)"


def _descent(items: str, weights: list[str], iterations: int, rate: float, half: bool, digits: int = 9) -> str:
    """Gradient descent as a recursive query over sums of products of ``items`` (x0, x1, ..., y)."""
    d = len(weights)
    sums = ["count(*)::DOUBLE AS n", "sum(y) AS sy", "sum(y * y) AS syy"]
    sums += [f"sum(x{i}) AS s{i}, sum(x{i} * y) AS sy{i}" for i in range(d)]
    sums += [f"sum(x{i} * x{j}) AS s{i}_{j}" for i in range(d) for j in range(i, d)]
    pair = lambda i, j: f"s{min(i, j)}_{max(i, j)}"
    r = "(sy - n * b" + "".join(f" - w{i} * s{i}" for i in range(d)) + ")"
    rx = [f"(sy{i} - b * s{i}" + "".join(f" - w{j} * {pair(i, j)}" for j in range(d)) + ")" for i in range(d)]
    ry = "(syy - b * sy" + "".join(f" - w{i} * sy{i}" for i in range(d)) + ")"
    rr = f"({ry} - b * {r}" + "".join(f" - w{i} * {rx[i]}" for i in range(d)) + ")"
    cost, step = (f"{rr} / (2 * n)", 1) if half else (f"{rr} / n", 2)
    moved = ", ".join(f"w{i} + rate * {step} * {rx[i]} / n AS w{i}" for i in range(d))
    w = ", ".join(f"w{i}" for i in range(d))
    start = ", ".join(f"0.1::DOUBLE AS w{i}" for i in range(d))
    named = ", ".join(f"round(w{i}, {digits}) AS {n}" for i, n in enumerate(weights))
    return f"""WITH RECURSIVE {items},
sums AS (SELECT {", ".join(sums)} FROM items),
steps AS (
  SELECT -1 AS i, 0::DOUBLE AS cost, 0.1::DOUBLE AS b, {start}, {rate}::DOUBLE AS rate
  UNION ALL
  SELECT i, new_cost, new_b, {", ".join(f"new_w{k}" for k in range(d))},
         CASE WHEN new_cost > cost THEN rate * 0.5 WHEN new_cost < cost THEN rate * 1.05 ELSE rate END
  FROM (SELECT i + 1 AS i, cost, rate, {cost} AS new_cost, b + rate * {step} * {r} / n AS new_b,
               {moved.replace(" AS w", " AS new_w")}
        FROM steps, sums WHERE i < {iterations - 1}) t)
SELECT i::BIGINT AS iteration, round(cost, {digits}) AS cost, round(b, {digits}) AS b, {named} FROM steps WHERE i >= 0"""


def _raw_descent(items: str, weights: list[str], iterations: int, rate: float, half: bool) -> str:
    """The residual form: each step averages over all items. Four significant digits, as raw columns make it diverge."""
    d = len(weights)
    residual = "y - b" + "".join(f" - w{i} * x{i}" for i in range(d))
    sums = "avg(r) AS r, avg(r * r) AS rr" + "".join(f", avg(x{i} * r) AS r{i}" for i in range(d))
    w = ", ".join(f"w{i}" for i in range(d))
    cost, step = ("rr / 2", 1) if half else ("rr", 2)
    moved = "".join(f", w{i} + rate * {step} * r{i} AS w{i}" for i in range(d))
    start = ", ".join(f"0.1::DOUBLE AS w{i}" for i in range(d))
    shown = ", ".join(f"printf('%.3e', {c}) AS {n}" for c, n in [("cost", "cost"), ("b", "b"), *((f"w{i}", n) for i, n in enumerate(weights))])
    return f"""WITH RECURSIVE {items},
steps AS (
  SELECT -1 AS i, 0::DOUBLE AS cost, 0.1::DOUBLE AS b, {start}, {rate}::DOUBLE AS rate
  UNION ALL
  SELECT i + 1, {cost} AS cost, b + rate * {step} * r AS b{moved},
         CASE WHEN {cost} > cost THEN rate * 0.5 WHEN {cost} < cost THEN rate * 1.05 ELSE rate END
  FROM (SELECT i, cost, b, {w}, rate, {sums}
        FROM (SELECT steps.*, {", ".join(f"x{i}" for i in range(d))}, {residual} AS r FROM steps, items WHERE i < {iterations - 1})
        GROUP BY i, cost, b, {w}, rate) t)
SELECT i::BIGINT AS iteration, {shown} FROM steps WHERE i >= 0"""


PLANE = ["w0", "w1", "w2", "w3"]
STANDARD_TRIPS = (
    "items AS (SELECT "
    + ", ".join(
        f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS x{i}"
        for i, c in enumerate(["duration", "distance", "fare", "surcharge"])
    )
    + f", amount / 1000 AS y FROM trips WHERE {REGULAR})"
)
ORACLE["gd_line_trace"] = _descent(_items(["quantity"]), ["m"], 100, 1e-4, half=False)
ORACLE["gd_multi_trace"] = _descent(_items(list(XS)), PLANE, 100, 1e-3, half=True)
ORACLE["gd_multi_passes"] = _descent(_items(list(XS)), PLANE, 100, 1e-3, half=True)
ORACLE["gd_trip_trace"] = _descent(f"{TRIPS},\n{STANDARD_TRIPS}", PLANE, 100, 1e-3, half=True, digits=6)

RAW_LINE = f"items AS MATERIALIZED (SELECT distance AS x0, fare AS y FROM trips WHERE {REGULAR})"
RAW_TRIPS = (
    "items AS MATERIALIZED (SELECT duration AS x0, distance AS x1, fare AS x2, surcharge AS x3, amount AS y"
    f" FROM trips WHERE {REGULAR})"
)
ORACLE["gd_line_raw"] = _raw_descent(f"{TRIPS},\n{RAW_LINE}", ["m"], 50, 1e-4, half=False)
ORACLE["gd_multi_factors"] = ORACLE["gd_multi_passes"]
ORACLE["gd_trip_raw"] = _raw_descent(f"{TRIPS},\n{RAW_TRIPS}", PLANE, 100, 1e-3, half=True)

# Words and features

WORDS = """words AS MATERIALIZED (
  SELECT doc_id, lower(w) AS word FROM documents, unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS t(w))"""
VOCAB = """vocab AS MATERIALIZED (
  SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word) - 1 AS pos
  FROM (SELECT word, count(*) AS cnt FROM words GROUP BY word)
  QUALIFY pos < 20000)"""
COUNTS = """counts AS MATERIALIZED (
  SELECT doc_id, pos, count(*) AS cnt FROM words JOIN vocab USING (word) GROUP BY ALL)"""
TF = "tf AS (SELECT doc_id, pos, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM counts)"
DF = "df AS (SELECT pos, count(*) AS df FROM counts GROUP BY pos)"
IDF = "idf AS (SELECT pos, df, ln((SELECT count(*) FROM documents) / df) AS idf FROM df)"
IDF_SMOOTH = "idf AS (SELECT pos, df, ln((SELECT count(*) FROM documents) / (df + 1)) AS idf FROM df)"
FEATS = "feats AS MATERIALIZED (SELECT doc_id, pos, tf * idf AS x FROM tf JOIN idf USING (pos))"
TEXT = (WORDS, VOCAB, COUNTS, TF, DF)
LABELS = "marks AS (SELECT doc_id, quality AS label FROM labels)"

ORACLE["word_count"] = """
SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word"""
ORACLE["token_counts"] = _with(WORDS) + "SELECT word, count(*) AS cnt FROM words GROUP BY word"
ORACLE["stop_word_counts"] = _with(WORDS) + (
    "SELECT word, count(*) AS cnt FROM words WHERE word NOT IN ("
    + ", ".join(_quote(w) for w in STOP_WORDS)
    + ") GROUP BY word"
)
ORACLE["vocab_topf"] = _with(WORDS, VOCAB) + "SELECT word, pos, cnt FROM vocab"
ORACLE["vocab_summaries"] = _with(WORDS, VOCAB) + "SELECT word, pos, cnt FROM vocab WHERE pos < 500"
ORACLE["term_count_split"] = _with(WORDS, VOCAB.replace("20000", str(1 << 23)), COUNTS) + "SELECT doc_id, pos, cnt FROM counts"
ORACLE["term_count"] = _with(WORDS, VOCAB, COUNTS) + "SELECT doc_id, pos, cnt FROM counts"
ORACLE["term_frequency"] = _with(WORDS, VOCAB, COUNTS, TF) + "SELECT doc_id, pos, tf FROM tf"
ORACLE["document_frequency"] = _with(WORDS, VOCAB, COUNTS, DF) + "SELECT pos, df FROM df"
ORACLE["idf_plain"] = _with(*TEXT, IDF) + "SELECT pos, df, round(idf, 10) AS idf FROM idf"
ORACLE["idf_smooth"] = _with(*TEXT, IDF_SMOOTH) + "SELECT pos, df, round(idf, 10) AS idf FROM idf"
ORACLE["tfidf"] = _with(*TEXT, IDF, FEATS) + "SELECT doc_id, pos, round(x, 10) AS x FROM feats"
ORACLE["tfidf_smooth"] = _with(*TEXT, IDF_SMOOTH, FEATS) + "SELECT doc_id, pos, round(x, 10) AS x FROM feats"
ORACLE["class_df_share"] = _with(
    WORDS,
    LABELS,
    "chosen AS (SELECT unnest(['applicant', 'and', 'attack', 'protein', 'court', 'the', 'in']) AS word)",
    "sizes AS (SELECT label, count(DISTINCT doc_id) AS size FROM words JOIN marks USING (doc_id) GROUP BY label)",
    "hits AS (SELECT label, word, count(DISTINCT doc_id) AS df FROM words JOIN marks USING (doc_id) GROUP BY ALL)",
) + """
SELECT label::BIGINT AS label, word, coalesce(df, 0) / size AS share
FROM sizes CROSS JOIN chosen LEFT JOIN hits USING (label, word)"""

# Text parsing

LINES = """lines AS (
  SELECT doc_id, CASE WHEN lang = 'es' THEN '<doc nid="' || doc_id || '">'
                 ELSE '<doc id="' || doc_id || '" url="u/' || source || '" title="t">' END
                 || regexp_replace(text, '[\\r\\n]+', ' ', 'g') || '</doc>' AS value
  FROM documents)"""
VALID = "valid AS (SELECT * FROM lines WHERE contains(value, 'id') AND contains(value, 'url='))"
PARSED = """parsed AS (
  SELECT regexp_extract(value, 'id="(.*?)" url=', 1, 's') AS doc_id,
         substr(value, instr(value, '">') + 2, greatest(length(value) - instr(value, '">') - 1 - 6, 0)) AS text
  FROM valid)"""
BODY = """bodies AS (
  SELECT doc_id, substr(value, instr(value, '>'), instr(value, '</doc>') - instr(value, '>')) AS body FROM lines)"""
BLANKS = (
    "[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
)
CORPUS_WORDS = f"""corpus_words AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, trim(lower(w), {_quote(EDGE_MARKS)}) AS word
    FROM bodies, unnest(regexp_split_to_array(body, '{BLANKS}')) AS t(w))
  WHERE length(word) > 1)"""
COUNTED_WORDS = f"""counted_words AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, trim(lower(w), {_quote(ASCII_PUNCTUATION)}) AS word
    FROM bodies, unnest(string_split(body, ' ')) AS t(w) WHERE regexp_matches(w, '[A-Za-z][\\p{{L}}\\p{{N}}_]'))
  WHERE length(word) > 2)"""
CORPUS_VOCAB = VOCAB.replace("FROM words", "FROM corpus_words")

ORACLE["document_count"] = _with(LINES, VALID) + (
    "SELECT (SELECT count(*) FROM lines) AS all_lines, (SELECT count(*) FROM valid) AS valid_lines"
)
ORACLE["tagged_documents"] = _with(LINES, VALID, PARSED) + "SELECT doc_id, text FROM parsed"
ORACLE["tagged_files"] = _with(LINES, VALID, PARSED) + (
    "SELECT doc_id, len(regexp_extract_all(text, '[a-zA-Z]+'))::BIGINT AS tokens FROM parsed"
)
ORACLE["headers"] = _with(LINES) + "SELECT doc_id, regexp_extract(value, '<[^>]+>') AS header FROM lines"
ORACLE["bodies"] = _with(LINES, BODY) + "SELECT doc_id, body FROM bodies"
ORACLE["stripped_pages"] = "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages"
ORACLE["corpus_vocab"] = _with(LINES, BODY, CORPUS_WORDS, CORPUS_VOCAB) + "SELECT word, pos, cnt FROM vocab"
ORACLE["corpus_term_counts"] = _with(LINES, BODY, CORPUS_WORDS, CORPUS_VOCAB, COUNTED_WORDS) + (
    "SELECT doc_id, pos, count(*) AS cnt FROM counted_words JOIN vocab USING (word) GROUP BY ALL"
)
ORACLE["plain_links"] = "SELECT doc_id::VARCHAR AS doc_id, source AS category FROM documents"
ORACLE["csv_links"] = "SELECT doc_id::VARCHAR AS doc_id, source || ',' || lang AS category FROM documents"

# Similarity search

QUERIES = (
    "qwords AS (SELECT item_id AS query_id, lower(w) AS word FROM benchmark,"
    " unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS t(w))",
    "qcounts AS (SELECT query_id, pos, count(*) AS cnt FROM qwords JOIN vocab USING (word) GROUP BY ALL)",
    "qtf AS (SELECT query_id, pos, cnt / sum(cnt) OVER (PARTITION BY query_id) AS tf FROM qcounts)",
    "qfeats AS (SELECT query_id, pos, tf * idf AS x FROM qtf JOIN idf USING (pos))",
)


def _scores(metric: str) -> tuple[str, ...]:
    dots = (
        "dots AS (SELECT query_id, doc_id, sum(f.x * q.x) AS dot FROM feats f JOIN qfeats q USING (pos) GROUP BY ALL)",
        "doc_norms AS (SELECT doc_id, sqrt(sum(x * x)) AS dn FROM feats GROUP BY doc_id)",
        "query_norms AS (SELECT query_id, sqrt(sum(x * x)) AS qn FROM qfeats GROUP BY query_id)",
    )
    score = "coalesce(dot, 0)" if metric == "dot" else "coalesce(dot, 0) / nullif(dn, 0) / nullif(qn, 0)"
    return dots + (
        f"raw AS (SELECT query_id, doc_id, {score} AS score"
        " FROM query_norms CROSS JOIN doc_norms LEFT JOIN dots USING (query_id, doc_id))",
        "scores AS (SELECT query_id, doc_id, round(score, 12) AS score FROM raw)",
    )


NEAREST = (
    "links AS (SELECT doc_id, lang AS category FROM documents UNION ALL SELECT doc_id, source FROM documents)",
    "nearest AS (SELECT query_id, doc_id, category, score, row_number() OVER (PARTITION BY query_id"
    " ORDER BY score DESC NULLS LAST, category, doc_id) AS rank FROM scores JOIN links USING (doc_id)"
    " QUALIFY rank <= 10)",
)

ORACLE["knn_scores"] = _with(*TEXT, IDF, FEATS, *QUERIES, *_scores("dot")) + (
    "SELECT query_id, doc_id, round(dot, 9) AS score FROM dots"
)
for _name, _metric in (("knn_dot", "dot"), ("knn_cosine", "cosine")):
    ORACLE[_name] = _with(*TEXT, IDF, FEATS, *QUERIES, *_scores(_metric), *NEAREST) + (
        "SELECT query_id, rank, doc_id, category, score FROM nearest"
    )
ORACLE["knn_vote"] = _with(*TEXT, IDF, FEATS, *QUERIES, *_scores("dot"), *NEAREST) + """
SELECT query_id, category, votes, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, category) AS place
FROM (SELECT query_id, category, count(*) AS votes FROM nearest GROUP BY query_id, category) QUALIFY place <= 10"""

# Scoring and evaluation under fixed weights

FIXED = "fixed AS (SELECT pos, word, ((pos * 7919) % 2001 - 1000) / 1000.0::DOUBLE AS weight FROM vocab)"
SCORED = (
    "linear AS (SELECT doc_id, sum(x * weight) AS score FROM feats JOIN fixed USING (pos) GROUP BY doc_id)",
    LABELS,
    "scored AS (SELECT doc_id, label, CASE WHEN score < 0 THEN 0 ELSE 1 END AS prediction"
    " FROM linear JOIN marks USING (doc_id))",
)
SMOOTH = (*TEXT, IDF_SMOOTH, FEATS, FIXED)
CLASSES = (
    "classes AS (SELECT unnest([0, 1]) AS label)",
    "tallies AS (SELECT c.label, count(*) FILTER (s.label = c.label AND s.prediction = c.label) AS hit,"
    " count(*) FILTER (s.prediction = c.label) AS said, count(*) FILTER (s.label = c.label) AS support"
    " FROM scored s CROSS JOIN classes c GROUP BY c.label)",
    "report AS (SELECT label, support, coalesce(hit / nullif(said, 0), 0) AS precision,"
    " coalesce(hit / nullif(support, 0), 0) AS recall,"
    " coalesce(2 * hit / nullif(said + support, 0), 0) AS f1 FROM tallies)",
)

ORACLE["linear_score"] = _with(*SMOOTH, *SCORED) + (
    "SELECT doc_id, round(score, 9) AS score, CASE WHEN score < 0 THEN 0 ELSE 1 END::BIGINT AS prediction FROM linear"
)
ORACLE["top_words_by_weight"] = _with(WORDS, VOCAB, FIXED) + (
    "SELECT word, pos, weight FROM fixed ORDER BY weight DESC, pos LIMIT 10"
)
ORACLE["confusion_matrix"] = _with(*SMOOTH, *SCORED) + """
SELECT a.v::BIGINT AS label, p.v::BIGINT AS prediction,
       (SELECT count(*) FROM scored WHERE label = a.v AND prediction = p.v) AS n
FROM (SELECT unnest([0, 1]) AS v) a CROSS JOIN (SELECT unnest([0, 1]) AS v) p"""
ORACLE["f1_binary"] = _with(*SMOOTH, *SCORED, *CLASSES) + "SELECT round(f1, 12) AS f1 FROM report WHERE label = 1"
ORACLE["f1_weighted"] = _with(*SMOOTH, *SCORED, *CLASSES) + (
    "SELECT round(sum(f1 * support) / sum(support), 12) AS f1 FROM report"
)
ORACLE["class_report"] = _with(*SMOOTH, *SCORED, *CLASSES) + """
SELECT label::BIGINT AS label, round(precision, 12) AS precision, round(recall, 12) AS recall,
       round(f1, 12) AS f1, support FROM report"""


def _held(*parts: str) -> tuple[str, ...]:
    """The parts, each worked out once."""
    return tuple(p if " AS MATERIALIZED (" in p else p.replace(" AS (", " AS MATERIALIZED (", 1) for p in parts)


def _first_wrong(weights: str, features: str, weight: str) -> tuple[str, ...]:
    """The ten heaviest words, the first three false positives, and the features where both meet."""
    return _held(
        f"best AS (SELECT word, pos, {weight} AS weight FROM {weights} QUALIFY row_number() OVER (ORDER BY {weight} DESC, pos) <= 10)",
        "wrong AS (SELECT doc_id FROM scored WHERE prediction = 1 AND label = 0 QUALIFY row_number() OVER (ORDER BY doc_id) <= 3)",
        "asked AS (SELECT doc_id, word, pos FROM wrong, best)",
        f"met AS (SELECT doc_id, pos, x FROM {features} WHERE doc_id IN (SELECT doc_id FROM wrong) AND pos IN (SELECT pos FROM best))",
    )


ORACLE["false_positives"] = _with(*_held(*SMOOTH, *SCORED), *_first_wrong("fixed", "feats", "weight")) + (
    "SELECT doc_id, word, pos, round(coalesce(x, 0), 10) AS x FROM asked LEFT JOIN met USING (doc_id, pos)"
)


def _uniform(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5({key} || ':{seed}'), 1, 13))::BIGINT::DOUBLE / 4503599627370496)"


ORACLE["split_hash"] = f"SELECT doc_id, floor({_uniform('doc_id', '7')} * 3)::BIGINT + 1 AS part FROM labels"
ORACLE["uniform_draw"] = f"SELECT doc_id, {_uniform('doc_id', '3:7')} AS u FROM documents"
ORACLE["positive_share"] = """
SELECT avg(label) AS share, sum(label)::BIGINT AS positives FROM (
  SELECT CASE WHEN contains(upper(lang) || '-' || doc_id, 'EN') THEN 1 ELSE 0 END AS label FROM documents)"""

# Gradients


def _gradient(cost: str, slope: str) -> str:
    return _with(
        *SMOOTH,
        LABELS,
        "led AS (SELECT doc_id, pos, x, label, weight,"
        " pos = min(pos) OVER (PARTITION BY doc_id) AS lead, sum(x * weight) OVER (PARTITION BY doc_id) AS theta"
        " FROM feats JOIN marks USING (doc_id) JOIN fixed USING (pos))",
    ) + f"""
SELECT pos, round(sum(x * ({slope})), 9) AS gradient, round(coalesce(sum({cost}) FILTER (lead), 0), 9) AS cost
FROM led GROUP BY pos"""


HINGE = ("greatest(1 - (2 * label - 1) * theta, 0)", "CASE WHEN 1 - (2 * label - 1) * theta > 0 THEN 1 - 2 * label ELSE 0 END")
CLASS_WEIGHT = "CASE WHEN label = 1 THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END"
ORACLE["logistic_gradient"] = _gradient("ln(1 + exp(theta)) - label * theta", "1 / (1 + exp(-theta)) - label")
ORACLE["hinge_gradient"] = _gradient(*HINGE)
ORACLE["weighted_hinge_gradient"] = _gradient(f"{HINGE[0]} * {CLASS_WEIGHT}", f"({HINGE[1]}) * {CLASS_WEIGHT}")

# Fits: the weights of one step are the working table of a recursive query


UNIT, SLOPE_UNIT = "1073741824::DOUBLE", "16777216::DOUBLE"


def _fit(
    features: tuple[str, ...],
    loss: tuple[str, str],
    rate: float,
    cost: str = "data_cost",
    penalty: str = "0",
    divisor: str = "1",
    up: float = 1.05,
    last: float = 0.0,
    break_on_rise: bool = False,
    cost_stop: float = -1.0,
    sgd: bool = False,
    steps: int = 1000,
    labels: str = "",
    all_docs: str = "SELECT count(*) FROM documents",
    share: str = "SELECT avg(label) FROM marks",
    after: tuple[str, ...] = (),
    result: str = "",
    exact: bool = False,
) -> str:
    """A descent and its trace, or ``result`` over it. ``ww`` in ``cost`` is |w|^2. ``exact``: sums of whole numbers, which have no order."""
    word, theta, slope, square = "x", "sum(x * w)", f"sum(x * ({loss[1]}))", "sum({0} * {0})"
    data_cost = f"sum({loss[0]})"
    if exact:
        word, theta = f"floor(x * {UNIT} + 0.5) AS x", f"sum(floor(x * w + 0.5)::BIGINT)::DOUBLE / {UNIT}"
        data_cost = f"sum(floor(({loss[0]}) * {SLOPE_UNIT} + 0.5)::BIGINT)::DOUBLE / {SLOPE_UNIT}"
        slope = f"sum(floor(x * (floor(({loss[1]}) * {SLOPE_UNIT} + 0.5) / {SLOPE_UNIT}) + 0.5)::BIGINT)::DOUBLE / {UNIT}"
        square = f"sum(floor({{0}} * {{0}} * {UNIT} + 0.5)::BIGINT)"
    squared = (lambda v, over="": f"({square.format(v)}{over})::DOUBLE / {UNIT}") if exact else (lambda v, over="": f"{square.format(v)}{over}")
    if sgd:
        move = "w * (1 - rate * 0.01) - rate * coalesce(g, 0) / n"
        # The step shrinks with the root of the step number; the stop looks at the moved weights.
        next_rate, stop = "1 / sqrt(i + 3)", "(i >= 0 AND moved < 0.001 * greatest(after, 1))"
    else:
        move = f"w - rate * (coalesce(g, 0) / {divisor} + {penalty} * w)"
        next_rate = f"CASE WHEN cost > last THEN rate * 0.5 WHEN cost < last THEN rate * {up} ELSE rate END"
        stop = f"(abs(after - sqrt(ww)) < 0.001 OR abs(last - cost) < {cost_stop})"
    halt = "cost > last" if break_on_rise else "false"
    return _with_recursive(
        *features,
        labels or LABELS,
        f"led AS MATERIALIZED (SELECT doc_id, pos, {word}, label FROM feats JOIN marks USING (doc_id))",
        "sizes AS MATERIALIZED (SELECT count(DISTINCT doc_id)::DOUBLE AS n,"
        f" ({all_docs})::DOUBLE AS all_docs, ({share})::DOUBLE AS share FROM led)",
        f"""steps AS (
  SELECT -1 AS i, pos::BIGINT AS pos, 0::DOUBLE AS w, {rate}::DOUBLE AS rate, {last}::DOUBLE AS last,
         0::DOUBLE AS cost, 0::DOUBLE AS norm, 0::DOUBLE AS used, false AS stop FROM vocab
  UNION ALL
  SELECT i + 1, pos, new_w, {next_rate}, cost, cost, after, rate, {stop}
  FROM (
    WITH margins AS MATERIALIZED (
      SELECT doc_id, any_value(label) AS label, {theta} AS theta, any_value(share) AS share
      FROM led JOIN steps USING (pos), sizes GROUP BY doc_id)
    SELECT *, sqrt({squared("new_w", " OVER ()")}) AS after, sqrt(sum((new_w - w) * (new_w - w)) OVER ()) AS moved
    FROM (
      SELECT s.i, s.pos, s.w, s.rate, s.last, ww, n, {cost} AS cost, {move} AS new_w
      FROM steps s LEFT JOIN (
        SELECT pos, {slope} AS g
        FROM led JOIN (SELECT doc_id, theta, share FROM margins) USING (doc_id)
        GROUP BY pos) USING (pos),
      (SELECT {data_cost} AS data_cost FROM margins),
      (SELECT {squared("w")} AS ww FROM steps), sizes
      WHERE s.i < {steps - 1} AND NOT s.stop))
  WHERE NOT ({halt}))""",
        *after,
    ) + (result or TRACE)


TRACE = """
SELECT DISTINCT i::BIGINT AS iteration, round(cost, 6) AS cost, round(norm, 6) AS norm, round(used, 9) AS rate
FROM steps WHERE i >= 0"""


def _with_recursive(*parts: str) -> str:
    return _with(*parts).replace("WITH ", "WITH RECURSIVE ", 1)


GRID = """
SELECT a.v::BIGINT AS label, p.v::BIGINT AS prediction,
       (SELECT count(*) FROM scored WHERE label = a.v AND prediction = p.v) AS n
FROM (SELECT unnest([0, 1]) AS v) a CROSS JOIN (SELECT unnest([0, 1]) AS v) p"""
TF_FEATS = (*TEXT, "feats AS (SELECT doc_id, pos, tf AS x FROM tf)")
TFIDF_FEATS = (*TEXT, IDF_SMOOTH, FEATS)
LOGISTIC = ("ln(1 + exp(theta)) - label * theta", "1 / (1 + exp(-theta)) - label")
SHARE_WEIGHT = "CASE WHEN label = 1 THEN 1 - share ELSE share END"
ORACLE["logit_l2_gd"] = _fit(TFIDF_FEATS, LOGISTIC, 0.1, cost="data_cost + 0.001 * ww", penalty="0.002", exact=True)
ORACLE["logit_sgd"] = _fit(TFIDF_FEATS, LOGISTIC, 1.0, cost="data_cost / n + 0.005 * ww", sgd=True, steps=300)
ORACLE["svm_sgd"] = _fit(TFIDF_FEATS, HINGE, 1.0, cost="data_cost / n + 0.005 * ww", sgd=True, steps=200)
ORACLE["svm_hinge"] = _fit(
    TF_FEATS, HINGE, 1.0, cost="data_cost / all_docs + 25 / all_docs * ww", penalty="50 / all_docs",
    divisor="all_docs", last=999999.0, break_on_rise=True,
)
WEIGHTED = (f"{HINGE[0]} * {SHARE_WEIGHT}", f"({HINGE[1]}) * {SHARE_WEIGHT}")
ORACLE["svm_weighted"] = _fit(
    TF_FEATS, WEIGHTED, 1.0,
    up=1.005, last=9999999.0, cost_stop=0.5,
)

EN_MARK = "CASE WHEN contains(doc_id, 'EN') THEN 1 ELSE 0 END AS label"
FOLDED_GRID = GRID.replace(
    "AS n\n", "AS n,\n       (SELECT round(coalesce(2 * count(*) FILTER (label = 1 AND prediction = 1) / nullif(\n"
    "         count(*) FILTER (label = 1) + count(*) FILTER (prediction = 1), 0), 0), 12) FROM scored) AS f1\n"
)


TEST_IDF = (
    "test_df AS (SELECT pos, count(*) AS df FROM test_counts GROUP BY pos)",
    "test_idf AS (SELECT pos, ln((SELECT count(*) FROM lines_ WHERE part = 3) / (df + 1)) AS idf FROM test_df)",
)


def _validated(doc_id: str, result: str, kind: str = "logistic", refit: bool = False) -> str:
    """Two thirds of the lines train, the rest test; lines that share an id are one document."""
    n_train = "SELECT count(*) FROM lines_ WHERE part < 3"
    fits = {
        "logistic": (LOGISTIC, 0.1, dict(cost="data_cost + 0.001 * ww", penalty="0.002", exact=True)),
        "svm": (
            HINGE,
            1.0,
            dict(
                cost="data_cost / all_docs + 25 / all_docs * ww", penalty="50 / all_docs", divisor="all_docs",
                last=999999.0, break_on_rise=True,
            ),
        ),
        "weighted": (WEIGHTED, 1.0, dict(up=1.005, last=9999999.0, cost_stop=0.5)),
    }
    loss, rate, options = fits[kind]
    logistic = kind == "logistic"
    weigh = ("test_idf" if refit else "idf") if logistic else None
    return _fit(
        (
            f"lines_ AS (SELECT {doc_id} AS doc_id, text, floor({_uniform('doc_id', '7')} * 3) + 1 AS part FROM documents)",
            "all_words AS MATERIALIZED (SELECT doc_id, part, lower(w) AS word FROM lines_,"
            " unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS t(w))",
            "words AS (SELECT doc_id, word FROM all_words WHERE part < 3)",
            VOCAB,
            COUNTS,
            TF,
            DF,
            *(
                (IDF_SMOOTH.replace("FROM documents", "FROM lines_ WHERE part < 3"), FEATS)
                if logistic
                else ("feats AS MATERIALIZED (SELECT doc_id, pos, tf AS x FROM tf)",)
            ),
        ),
        loss,
        rate,
        labels=f"marks AS (SELECT DISTINCT doc_id, {EN_MARK} FROM lines_ WHERE part < 3)",
        all_docs=n_train,
        share=f"SELECT count(*) FILTER (label = 1) / ({n_train}) FROM (SELECT DISTINCT doc_id, label FROM led)",
        after=(
            "test_counts AS (SELECT doc_id, pos, count(*) AS cnt FROM all_words JOIN vocab USING (word)"
            " WHERE part = 3 GROUP BY ALL)",
            "test_tf AS (SELECT doc_id, pos, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM test_counts)",
            *(TEST_IDF if refit else ()),
            f"test_feats AS MATERIALIZED (SELECT doc_id, pos, tf * idf AS x FROM test_tf JOIN {weigh} USING (pos))"
            if weigh
            else "test_feats AS MATERIALIZED (SELECT doc_id, pos, tf AS x FROM test_tf)",
            "final AS MATERIALIZED (SELECT pos, w FROM steps WHERE i = (SELECT max(i) FROM steps))",
            f"scored AS MATERIALIZED (SELECT doc_id, {EN_MARK}, CASE WHEN sum(x * w) < 0 THEN 0 ELSE 1 END"
            " AS prediction FROM test_feats JOIN final USING (pos) GROUP BY doc_id)",
        ),
        result=result,
        **options,
    )


FITTED_WORDS = ",\n" + ",\n".join(
    _first_wrong("(SELECT word, pos, w FROM final JOIN vocab USING (pos))", "test_feats", "w")
) + """
SELECT 'top word' AS kind, word, '' AS doc_id, round(weight, 4) AS value FROM best
UNION ALL
SELECT 'false positive', word, doc_id, round(coalesce(x, 0), 8) FROM asked LEFT JOIN met USING (doc_id, pos)"""
OWN_IDS = "upper(lang) || doc_id"
ORACLE["train_and_validate"] = _validated(OWN_IDS, GRID)
ORACLE["validate_svm"] = _validated(OWN_IDS, GRID, "svm")
ORACLE["validate_weighted_svm"] = _validated(OWN_IDS, GRID, "weighted")
ORACLE["fitted_words"] = _validated(OWN_IDS, FITTED_WORDS, refit=True)
ORACLE["repeated_ids_report"] = _validated(
    "CASE WHEN doc_id % 3 = 0 THEN 'EN' ELSE upper(lang) || doc_id END", FOLDED_GRID
)


def _optimum(marks: str) -> tuple[str, ...]:
    """Weights at the optimum of mean logistic loss + 0.005 |w|^2 on tf, by descent with momentum until nothing moves.

    Rows of tf add up to 1, so the curvature lies between 0.01 and 0.26, and each step leaves less than four fifths of the way.
    """
    return (
        *TF_FEATS,
        marks,
        "led AS MATERIALIZED (SELECT doc_id, pos, x, label FROM feats JOIN marks USING (doc_id))",
        "sizes AS MATERIALIZED (SELECT count(DISTINCT doc_id)::DOUBLE AS n FROM led)",
        "known AS MATERIALIZED (SELECT DISTINCT pos FROM led)",
        """steps AS (
  SELECT 0 AS i, pos, 0::DOUBLE AS w, 0::DOUBLE AS moved FROM known
  UNION ALL
  SELECT i + 1, pos, w + move, move FROM (
    SELECT s.i, s.pos, s.w, 0.6 * s.moved - 8 * (g / n + 0.01 * s.w) AS move
    FROM steps s JOIN (
      SELECT pos, sum(x * slope) AS g FROM led JOIN (
        SELECT doc_id, 1 / (1 + exp(-sum(x * w))) - any_value(label) AS slope FROM led JOIN steps USING (pos) GROUP BY doc_id) USING (doc_id)
      GROUP BY pos) USING (pos), sizes WHERE s.i < 100))""",
        "best AS MATERIALIZED (SELECT pos, w FROM steps WHERE i = 100)",
    )


ORACLE["lbfgs_optimum"] = _with_recursive(
    *_optimum(LABELS),
    "every AS MATERIALIZED (SELECT word, pos, round(coalesce(w, 0), 4) AS weight FROM vocab LEFT JOIN best USING (pos))",
) + """
(SELECT * FROM every ORDER BY weight DESC, pos LIMIT 50) UNION ALL (SELECT * FROM every ORDER BY weight, pos LIMIT 50)"""
PARTS = f"parts AS (SELECT doc_id, quality AS label, floor({_uniform('doc_id', '7')} * 3) + 1 AS part FROM labels)"
ORACLE["lbfgs_held_out"] = _with_recursive(
    PARTS,
    *_optimum("marks AS (SELECT doc_id, label FROM parts WHERE part < 3)"),
    "scored AS (SELECT doc_id, label, CASE WHEN sum(x * coalesce(w, 0)) < 0 THEN 0 ELSE 1 END AS prediction"
    " FROM feats JOIN parts USING (doc_id) LEFT JOIN best USING (pos) WHERE part = 3 GROUP BY ALL)",
    *CLASSES,
) + """
SELECT label::BIGINT AS label, round(precision, 12) AS precision, round(recall, 12) AS recall,
       round(f1, 12) AS f1, support FROM report"""

# Naive Bayes


def _likelihoods(x: str) -> tuple[str, ...]:
    return (
        LABELS,
        f"rows_ AS (SELECT doc_id, pos, label, {x} AS x FROM {'tf' if x == 'tf' else 'counts'} JOIN marks USING (doc_id))",
        "mass AS (SELECT v.pos, coalesce(sum(x) FILTER (label = 0), 0) + 1 AS m0,"
        " coalesce(sum(x) FILTER (label = 1), 0) + 1 AS m1 FROM vocab v LEFT JOIN rows_ r ON v.pos = r.pos GROUP BY v.pos)",
        "likelihoods AS (SELECT pos, ln(m0 / (SELECT sum(m0) FROM mass)) AS w0,"
        " ln(m1 / (SELECT sum(m1) FROM mass)) AS w1 FROM mass)",
    )


ORACLE["naive_bayes_likelihoods"] = _with(WORDS, VOCAB, COUNTS, TF, *_likelihoods("tf")) + (
    "SELECT pos, round(w0, 9) AS w0, round(w1, 9) AS w1 FROM likelihoods"
)
ORACLE["naive_bayes"] = _with(WORDS, VOCAB, COUNTS, *_likelihoods("cnt")) + """
SELECT doc_id, CASE WHEN sum(cnt * w1) + (SELECT ln((count(*) FILTER (label = 1) + 1) / (count(*) + 2)) FROM marks)
                       > sum(cnt * w0) + (SELECT ln((count(*) FILTER (label = 0) + 1) / (count(*) + 2)) FROM marks)
               THEN 1 ELSE 0 END::BIGINT AS prediction
FROM counts JOIN likelihoods USING (pos) GROUP BY doc_id"""

ORACLE["naive_bayes_ml"] = _with(
    WORDS,
    VOCAB,
    "parts AS (SELECT doc_id, quality AS label, floor(" + _uniform("doc_id", "7") + " * 3) + 1 AS part FROM labels)",
    "marks AS (SELECT doc_id, label FROM parts WHERE part < 3)",
    COUNTS,
    TF,
    *_likelihoods("tf")[1:],
    "priors AS (SELECT ln((count(*) FILTER (label = 0) + 1) / (count(*) + 2)) AS p0,"
    " ln((count(*) FILTER (label = 1) + 1) / (count(*) + 2)) AS p1 FROM marks)",
    "scored AS (SELECT doc_id, any_value(label) AS label, CASE WHEN sum(tf * w1) + any_value(p1)"
    " > sum(tf * w0) + any_value(p0) THEN 1 ELSE 0 END AS prediction"
    " FROM tf JOIN likelihoods USING (pos) JOIN parts USING (doc_id), priors WHERE part = 3 GROUP BY doc_id)",
    *CLASSES,
) + """
SELECT label::DOUBLE AS label, round(precision, 12) AS precision, round(recall, 12) AS recall,
       round(f1, 12) AS f1, support FROM report"""

# Mixture of multinomials

CLUSTERS = f"clusters AS (SELECT doc_id, floor({_uniform('doc_id', '5')} * 6)::BIGINT AS cluster FROM documents)"
MARKED = (
    "marked AS (SELECT doc_id, pos, cnt::DOUBLE AS x FROM counts UNION ALL SELECT doc_id, -1, 0 FROM documents)"
)
CLUSTER_COUNTS = (
    "cluster_counts AS (SELECT cluster, pos, sum(x) AS cnt, count(*) FILTER (pos = -1) AS docs"
    " FROM marked JOIN clusters USING (doc_id) GROUP BY ALL)"
)
MIXTURE = (
    WORDS,
    VOCAB,
    COUNTS,
    CLUSTERS,
    MARKED,
    CLUSTER_COUNTS,
    "grid AS (SELECT pos, j AS cluster FROM (SELECT DISTINCT pos FROM counts), unnest(range(6)) AS t(j))",
    "mass AS (SELECT pos, cluster, coalesce(cnt, 0) + 0.1::DOUBLE AS m FROM grid LEFT JOIN cluster_counts USING (cluster, pos))",
    "log_mu AS (SELECT pos, cluster, ln(m / sum(m) OVER (PARTITION BY cluster)) AS w FROM mass)",
    "raw AS (SELECT doc_id, cluster, sum(cnt * w) AS s FROM counts JOIN log_mu USING (pos) GROUP BY ALL)",
    "filled AS (SELECT doc_id, j AS cluster, coalesce(s, 0) AS s FROM documents CROSS JOIN unnest(range(6)) AS t(j)"
    " LEFT JOIN raw ON raw.doc_id = documents.doc_id AND raw.cluster = j)".replace(
        "SELECT doc_id,", "SELECT documents.doc_id,"
    ),
    "raised AS (SELECT doc_id, cluster, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM filled)",
    "probs AS (SELECT doc_id, cluster, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM raised)",
)
ORACLE["cluster_word_counts"] = _with(WORDS, VOCAB, COUNTS, CLUSTERS, MARKED, CLUSTER_COUNTS) + (
    "SELECT cluster, pos, cnt, docs FROM cluster_counts"
)
ORACLE["cluster_sizes"] = _with(CLUSTERS) + "SELECT cluster, count(*) AS n FROM clusters GROUP BY cluster"
ORACLE["mixture_probabilities"] = _with(*MIXTURE) + (
    "SELECT doc_id, "
    + ", ".join(f"round(max(p) FILTER (cluster = {j}), 6) AS p{j}" for j in range(6))
    + " FROM probs GROUP BY doc_id"
)
ORACLE["mixture_draw"] = _with(
    *MIXTURE,
    "running AS (SELECT doc_id, cluster, sum(p) OVER (PARTITION BY doc_id ORDER BY cluster) AS c FROM probs)",
) + f"""
SELECT doc_id, count(*) FILTER (cluster < 5 AND c <= {_uniform('doc_id', '3:7')}) AS cluster
FROM running GROUP BY doc_id"""
ORACLE["cluster_top_words"] = _with(WORDS, VOCAB, COUNTS, CLUSTERS, MARKED, CLUSTER_COUNTS) + """
SELECT cluster, row_number() OVER (PARTITION BY cluster ORDER BY c.cnt DESC, pos) AS rank, word, c.cnt AS cnt
FROM cluster_counts c JOIN vocab USING (pos) QUALIFY rank <= 100"""
ORACLE["cluster_purity"] = _with(
    CLUSTERS,
    "pairs AS (SELECT cluster, lang AS g, count(*) AS n FROM clusters JOIN documents USING (doc_id) GROUP BY ALL)",
    "sizes AS (SELECT cluster, sum(n)::BIGINT AS size FROM pairs GROUP BY cluster ORDER BY 2 DESC, 1 LIMIT 3)",
) + """
SELECT cluster::VARCHAR AS cluster, size, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, g) AS rank,
       g AS "group", n, n / size AS share
FROM pairs JOIN sizes USING (cluster) QUALIFY rank <= 3"""

ORACLE["gibbs_step"] = _with(
    *MIXTURE,
    "running AS (SELECT doc_id, cluster, sum(p) OVER (PARTITION BY doc_id ORDER BY cluster) AS c FROM probs)",
    f"drawn AS (SELECT doc_id, count(*) FILTER (cluster < 5 AND c <= {_uniform('doc_id', '3:7')}) AS drawn"
    " FROM running GROUP BY doc_id)",
) + """
SELECT drawn AS cluster, pos, sum(CASE WHEN pos = -1 THEN 1 ELSE x END) AS cnt
FROM marked JOIN drawn USING (doc_id) GROUP BY ALL"""


def _hex(digest: str, first: int, digits: int) -> str:
    return f"(('0x' || substr({digest}, {first}, {digits}))::BIGINT::DOUBLE + 0.5) / {16**digits}::DOUBLE"


def _drawn(name: str, counts: str, step: int) -> tuple[str, ...]:
    """ln shares of gamma draws by cluster and position, positions -1 for the clusters' own shares."""
    key = f"cluster || ':' || pos || ':{step}:'"
    tries = ", ".join(f"md5({key} || '{n}:7') AS h{n}" for n in range(5))
    normals = ", ".join(f"sqrt(-2 * ln({_hex(f'h{n}', 1, 13)})) * cos(6.283185307179586 * ({_hex(f'h{n}', 14, 13)})) AS x{n}" for n in range(5))
    cubes = ", ".join(f"(1 + x{n} / sqrt(9 * d)) * (1 + x{n} / sqrt(9 * d)) * (1 + x{n} / sqrt(9 * d)) AS v{n}" for n in range(5))
    taken = " ".join(f"WHEN v{n} > 0 AND ln({_hex(f'h{n}', 27, 6)}) < x{n} * x{n} / 2 + d - d * v{n} + d * ln(v{n}) THEN ln(v{n})" for n in range(5))
    shape = "coalesce(cnt, 0) + 0.1::DOUBLE"
    return (
        f"{name}_shapes AS MATERIALIZED (SELECT cluster, pos, {shape} AS a, CASE WHEN {shape} < 1 THEN {shape} + 1 ELSE {shape} END - 1.0::DOUBLE / 3 AS d,"
        f" md5({key} || '5:7') AS last, {tries} FROM cells LEFT JOIN {counts} USING (cluster, pos))",
        f"{name}_normals AS MATERIALIZED (SELECT *, {normals} FROM {name}_shapes)",
        f"{name}_cubes AS MATERIALIZED (SELECT *, {cubes} FROM {name}_normals)",
        f"{name}_logs AS MATERIALIZED (SELECT cluster, pos, ln(d) + CASE {taken} ELSE 0 END"
        f" + CASE WHEN a < 1 THEN ln({_hex('last', 1, 13)}) / a ELSE 0 END AS g FROM {name}_cubes)",
        f"{name} AS MATERIALIZED (SELECT cluster, pos, greatest(g - m - ln(sum(exp(g - m)) OVER w), ln(1e-300::DOUBLE)) AS w FROM"
        f" (SELECT *, max(g) OVER (PARTITION BY pos < 0, CASE WHEN pos < 0 THEN 0 ELSE cluster END) AS m FROM {name}_logs)"
        " WINDOW w AS (PARTITION BY pos < 0, CASE WHEN pos < 0 THEN 0 ELSE cluster END))",
    )


def _sweep(n: int) -> tuple[str, ...]:
    """Labels and counts of sweep n from the shares state{n}, and the next shares."""
    return (
        f"scores{n} AS (SELECT t.doc_id, p.cluster, p.w + coalesce(s, 0) AS s FROM lines t CROSS JOIN (SELECT cluster, w FROM state{n} WHERE pos < 0) p"
        f" LEFT JOIN (SELECT doc_id, cluster, sum(cnt * w) AS s FROM counts JOIN state{n} USING (pos) GROUP BY ALL) q"
        " ON q.doc_id = t.doc_id AND q.cluster = p.cluster)",
        f"shares{n} AS (SELECT doc_id, cluster, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM"
        f" (SELECT doc_id, cluster, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM scores{n}))",
        f"labels{n} AS MATERIALIZED (SELECT doc_id, count(*) FILTER (cluster < 5 AND c <= {_uniform('doc_id', f'{n}:7')}) AS cluster"
        f" FROM (SELECT doc_id, cluster, sum(p) OVER (PARTITION BY doc_id ORDER BY cluster) AS c FROM shares{n}) GROUP BY doc_id)",
        f"counts{n} AS MATERIALIZED (SELECT cluster, pos, sum(cnt)::DOUBLE AS cnt FROM counts JOIN labels{n} USING (doc_id) GROUP BY ALL"
        f" UNION ALL SELECT cluster, -1, count(*) FROM labels{n} GROUP BY cluster)",
        *_drawn(f"state{n + 1}", f"counts{n}", n + 1),
    )


ORACLE["fitted_clusters"] = _with(
    LINES,
    BODY,
    CORPUS_WORDS,
    CORPUS_VOCAB,
    COUNTED_WORDS,
    "counts AS MATERIALIZED (SELECT doc_id, pos, count(*) AS cnt FROM counted_words JOIN vocab USING (word) GROUP BY ALL)",
    "cells AS MATERIALIZED (SELECT j AS cluster, pos FROM unnest(range(6)) AS t(j), (SELECT pos FROM vocab UNION ALL SELECT -1))",
    "nothing AS (SELECT 0 AS cluster, 0 AS pos, 0::DOUBLE AS cnt WHERE false)",
    *_drawn("state0", "nothing", 0),
    *_sweep(0),
    *_sweep(1),
    *_sweep(2),
) + """
SELECT 'size' AS kind, j::BIGINT AS cluster, s::BIGINT AS place, '' AS name, coalesce(n, 0)::DOUBLE AS value
FROM unnest(range(6)) AS a(j) CROSS JOIN unnest(range(3)) AS b(s) LEFT JOIN (
  SELECT 0 AS s, cluster AS j, cnt AS n FROM counts0 WHERE pos < 0 UNION ALL SELECT 1, cluster, cnt FROM counts1 WHERE pos < 0
  UNION ALL SELECT 2, cluster, cnt FROM counts2 WHERE pos < 0) USING (j, s)
UNION ALL
SELECT 'word', cluster, place, word, value FROM (
  SELECT cluster::BIGINT AS cluster, row_number() OVER (PARTITION BY cluster ORDER BY w DESC, pos) AS place, word, round(w, 6) AS value
  FROM state3 JOIN vocab USING (pos) WHERE pos >= 0) WHERE place <= 100
UNION ALL
SELECT 'label', cluster, 0, doc_id::VARCHAR, 0 FROM labels2"""
ORACLE["cluster_files"] = _with(CLUSTERS) + (
    "SELECT cluster::VARCHAR AS cluster, count(*) AS n, true AS in_order FROM clusters GROUP BY 1"
)
ORACLE["zipped_clusters"] = _with(LINES, CLUSTERS) + (
    "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS n, regexp_extract(value, '<[^>]+>') AS header, cluster"
    " FROM lines JOIN clusters USING (doc_id)"
)
ORACLE["report_file"] = ORACLE["topk_count"]
ORACLE["table_file"] = ORACLE["document_frequency"]

# Reviews

REVIEWS = """reviews AS (
  SELECT doc_id::VARCHAR AS doc_id, CASE WHEN n_chars % 21 + 80 < 88 THEN 0 ELSE 1 END AS label, lower(w) AS word
  FROM (SELECT doc_id, n_chars, unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS w FROM documents
        WHERE doc_id % 11 <> 0 AND source <> 'src3'))"""
KEPT = "kept AS (SELECT * FROM reviews WHERE word NOT IN (" + ", ".join(_quote(w) for w in STOP_WORDS) + "))"
_REVIEW_LABELS = _with(REVIEWS, KEPT) + """
SELECT doc_id::VARCHAR AS doc_id, CASE WHEN n_chars % 21 + 80 < 88 THEN 0 ELSE 1 END::BIGINT AS label,
       (SELECT count(*) FROM kept WHERE kept.doc_id = documents.doc_id::VARCHAR) AS tokens
FROM documents WHERE doc_id % 11 <> 0 AND source <> 'src3'"""
ORACLE["review_labels"] = _REVIEW_LABELS
ORACLE["review_files"] = _REVIEW_LABELS
ORACLE["review_word_counts"] = _with(REVIEWS, KEPT) + (
    "SELECT label::BIGINT AS label, word, count(*) AS n FROM kept GROUP BY ALL"
)
ORACLE["review_complete"] = _REVIEW_LABELS


def _reviewed(loss: tuple[str, str], steps: int) -> str:
    """Class report on the held-out reviews of a model trained by full-batch SGD."""
    return _fit(
        (
            REVIEWS,
            KEPT.replace("kept AS", "words AS MATERIALIZED"),
            f"rated AS (SELECT DISTINCT doc_id::VARCHAR AS doc_id, CASE WHEN n_chars % 21 + 80 < 88 THEN 0 ELSE 1 END AS label,"
            f" floor({_uniform('doc_id', '7')} * 3) + 1 AS part FROM documents WHERE doc_id % 11 <> 0 AND source <> 'src3')",
            VOCAB,
            COUNTS,
            TF,
            DF,
            IDF_SMOOTH.replace("FROM documents", "FROM rated"),
            FEATS,
        ),
        loss,
        1.0,
        cost="data_cost / n + 0.005 * ww",
        sgd=True,
        steps=steps,
        labels="marks AS (SELECT doc_id, label FROM rated WHERE part < 3)",
        after=(
            "final AS (SELECT pos, w FROM steps WHERE i = (SELECT max(i) FROM steps))",
            "scored AS (SELECT doc_id, any_value(label) AS label, CASE WHEN sum(x * w) < 0 THEN 0 ELSE 1 END AS prediction"
            " FROM feats JOIN final USING (pos) JOIN rated USING (doc_id) WHERE part = 3 GROUP BY doc_id)",
            *CLASSES,
        ),
        result=REPORT,
    )


REPORT = """
SELECT label::BIGINT AS label, round(precision, 12) AS precision, round(recall, 12) AS recall,
       round(f1, 12) AS f1, support FROM report"""
ORACLE["review_sgd"] = _reviewed(LOGISTIC, 300)
ORACLE["review_svm"] = _reviewed(HINGE, 200)
ORACLE["review_bayes"] = _with(
    REVIEWS,
    KEPT.replace("kept AS", "words AS MATERIALIZED"),
    f"rated AS (SELECT DISTINCT doc_id::VARCHAR AS doc_id, CASE WHEN n_chars % 21 + 80 < 88 THEN 0 ELSE 1 END AS label,"
    f" floor({_uniform('doc_id', '7')} * 3) + 1 AS part FROM documents WHERE doc_id % 11 <> 0 AND source <> 'src3')",
    VOCAB,
    COUNTS,
    TF,
    DF,
    IDF_SMOOTH.replace("FROM documents", "FROM rated"),
    FEATS,
    "marks AS (SELECT doc_id, label FROM rated WHERE part < 3)",
    "mass AS (SELECT v.pos, coalesce(sum(x) FILTER (label = 0), 0) + 1 AS m0,"
    " coalesce(sum(x) FILTER (label = 1), 0) + 1 AS m1"
    " FROM vocab v LEFT JOIN (SELECT pos, x, label FROM feats JOIN marks USING (doc_id)) r ON v.pos = r.pos GROUP BY v.pos)",
    "likelihoods AS (SELECT pos, ln(m0 / (SELECT sum(m0) FROM mass)) AS w0,"
    " ln(m1 / (SELECT sum(m1) FROM mass)) AS w1 FROM mass)",
    "priors AS (SELECT ln((count(*) FILTER (label = 0) + 1) / (count(*) + 2)) AS p0,"
    " ln((count(*) FILTER (label = 1) + 1) / (count(*) + 2)) AS p1 FROM marks)",
    "scored AS (SELECT doc_id, any_value(label) AS label, CASE WHEN sum(x * w1) + any_value(p1)"
    " > sum(x * w0) + any_value(p0) THEN 1 ELSE 0 END AS prediction"
    " FROM feats JOIN likelihoods USING (pos) JOIN rated USING (doc_id), priors WHERE part = 3 GROUP BY doc_id)",
    *CLASSES,
) + REPORT
