"""The registered queries as SQL for an independent engine, over the same tables.

Nothing here is shared with the Spark side but parameter values; each statement is written from the definition.
"""

from __future__ import annotations

from lexiloom.functions.text import INDIC_STOP_WORDS
from lexiloom.plans import inputs as I

SP = r"\t\n\x0B\f\r\x85\p{Z}"
WD = r"\p{L}\p{M}\p{N}\p{Pc}"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _clean(col: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({col}), '[^{WD}{SP}]|\p{{Nd}}', '', 'g'), '[{SP}]+', ' ', 'g'))"


def _toks(col: str) -> str:
    return rf"list_filter(regexp_split_to_array({col}, '[{SP}]+'), lambda t: t <> '')"


LN = """ln AS (
  SELECT doc_id, i - 1 AS line, l AS sentence
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
  WHERE l <> '')"""
CL = f"cl AS (SELECT doc_id, line, {_clean('sentence')} AS clean FROM ln)"
TK = rf"""tk AS (
  SELECT doc_id, line, list_filter({_toks('clean')}, lambda t: length(t) >= 3 AND t NOT IN ({_list(I.STOP)})
         AND NOT regexp_matches(t, '^\p{{Nd}}+$')) AS toks FROM cl)"""
WORDS = """words AS (
  SELECT doc_id, line, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos FROM tk)"""
VOCAB = f"""vocab AS (
  SELECT word, freq, row_number() OVER (ORDER BY freq DESC, word) - 1 AS idx
  FROM (SELECT word, count(*) AS freq FROM words GROUP BY word HAVING count(*) >= {I.MIN_FREQ}))"""
ENC = """enc AS (
  SELECT doc_id, line, idx, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) - 1 AS pos
  FROM words JOIN vocab USING (word))"""
CORPUS = (LN, CL, TK, WORDS)
ENCODED = (*CORPUS, VOCAB, ENC)


def _cooc(windows, distance: bool = False) -> str:
    weight = "1.0 / abs(a.pos - b.pos)" if distance else "1.0"
    return f"""cooc AS (
  SELECT win AS "window", a.idx AS row, b.idx AS col, sum(CAST({weight} AS DOUBLE)) AS w
  FROM enc a JOIN enc b ON a.doc_id = b.doc_id AND a.line = b.line AND a.pos <> b.pos AND abs(a.pos - b.pos) <= {max(windows)}
  JOIN (SELECT unnest([{', '.join(map(str, windows))}]) AS win) ON abs(a.pos - b.pos) <= win
  GROUP BY win, a.idx, b.idx)"""


COOC2 = _with(*ENCODED, _cooc((2,)))
COOC2D = _with(*ENCODED, _cooc((2,), True))
COOC_ALL = _with(*ENCODED, _cooc(I.WINDOWS))

V = """v AS (SELECT vec_id AS word, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"""
O = """o AS (SELECT word, list_concat(vec[2:], vec[1:1]) AS vec FROM v)"""
NEXT = "pairs AS (SELECT vec_id AS src, vec_id + 1 AS tgt FROM embeddings)"
GOLD = """gold AS (SELECT doc_id AS pid, doc_id AS src, doc_id + 3 AS tgt,
  CAST((doc_id * 7) % 11 + quality AS DOUBLE) AS score FROM labels)"""


def _cos(a: str, b: str) -> str:
    return f"list_cosine_similarity({a}, {b})"


def _scored(source: str, target: str) -> str:
    return f"""scored AS (SELECT g.pid, g.score, {_cos('a.vec', 'b.vec')} AS cos
  FROM gold g JOIN {source} a ON a.word = g.src JOIN {target} b ON b.word = g.tgt)"""


SCORED = _scored("v", "v")
RANKED = """ranked AS (SELECT *,
  rank() OVER (ORDER BY cos) + (count(*) OVER (PARTITION BY cos) - 1) / 2.0 AS rx,
  rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ry FROM scored)"""
QUESTIONS = "qs AS (SELECT vec_id AS qid, vec_id AS a, vec_id + 1 AS b, vec_id + 2 AS c, vec_id + 3 AS d FROM embeddings)"
ASKED = """asked AS (
  SELECT q.*, list_transform(list_zip(va.vec, vb.vec, vc.vec), lambda r: r[2] - r[1] + r[3]) AS vec
  FROM qs q JOIN v va ON va.word = q.a JOIN v vb ON vb.word = q.b JOIN v vc ON vc.word = q.c JOIN v vd ON vd.word = q.d)"""
PREDICTED = f"""predicted AS (
  SELECT qid, a, b, c, d, predicted, cos FROM (
    SELECT q.qid, q.a, q.b, q.c, q.d, v.word AS predicted, {_cos('q.vec', 'v.vec')} AS cos,
      row_number() OVER (PARTITION BY q.qid ORDER BY round({_cos('q.vec', 'v.vec')}, 12) DESC, v.word) AS rn
    FROM asked q JOIN v ON v.word NOT IN (q.a, q.b, q.c)) WHERE rn = 1)"""
SIL = """dist AS (
  SELECT a.word, a.label AS own, b.label AS other, sum(list_distance(a.vec, b.vec)) AS d
  FROM v a JOIN v b ON a.word <> b.word GROUP BY a.word, a.label, b.label),
sizes AS (SELECT label, count(*) AS n FROM v GROUP BY label),
sil AS (
  SELECT word, own AS cluster, CASE WHEN max(CASE WHEN own = other THEN n END) > 1 THEN
    (min(CASE WHEN own <> other THEN d / n END) - max(CASE WHEN own = other THEN d / (n - 1) END))
    / greatest(min(CASE WHEN own <> other THEN d / n END), max(CASE WHEN own = other THEN d / (n - 1) END)) ELSE 0 END AS s
  FROM dist JOIN sizes ON label = other GROUP BY word, own)"""
def _ranks(source: str, target: str) -> str:
    return f"""ranks AS (
  SELECT p.src, p.tgt, CAST(1 AS BIGINT) AS n, {_cos('a.vec', 'b.vec')} AS cos,
    1 + (SELECT count(*) FROM {target} c WHERE {_cos('a.vec', 'c.vec')} > {_cos('a.vec', 'b.vec')} + 1e-12) AS rank
  FROM pairs p JOIN {source} a ON a.word = p.src JOIN {target} b ON b.word = p.tgt)"""


RANKS = _ranks("v", "v")


def _hubs(source: str, target: str, k: int) -> str:
    return f"""near AS (
  SELECT src, tgt FROM (SELECT a.word AS src, b.word AS tgt,
    row_number() OVER (PARTITION BY a.word ORDER BY round({_cos('a.vec', 'b.vec')}, 12) DESC, b.word) AS rn
    FROM {source} a, {target} b) WHERE rn <= {k}),
hubs AS (SELECT t.word, count(near.tgt) AS hits FROM {target} t LEFT JOIN near ON near.tgt = t.word GROUP BY t.word),
hub AS (SELECT max(hits) AS max_hub_size, avg(hits) AS mean_hub_size, stddev_pop(hits) AS std_hub_size,
  avg(power((hits - m) / s, 3)) AS skewness FROM hubs, (SELECT avg(hits) AS m, stddev_pop(hits) AS s FROM hubs))"""


def _evaluate(method: str, source: str, target: str) -> str:
    parts = _with(V, O, NEXT, GOLD, _ranks(source, target), _scored(source, target), RANKED, _hubs(source, target, 10))
    return parts + f"""SELECT '{method}' AS method, round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0 END), 6) AS p_at_1,
  round(avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0 END), 6) AS p_at_5, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0 END), 6) AS p_at_10,
  round(avg(1.0 / rank), 6) AS mrr, (SELECT round(corr(rx, ry), 6) FROM ranked) AS spearman_correlation,
  (SELECT round(avg(abs(cos - score)), 6) FROM ranked) AS mean_absolute_error, (SELECT max_hub_size FROM hub) AS max_hub_size,
  (SELECT round(mean_hub_size, 6) FROM hub) AS mean_hub_size, (SELECT round(std_hub_size, 6) FROM hub) AS std_hub_size,
  (SELECT round(skewness, 6) FROM hub) AS skewness FROM ranks"""


SETS = f"""sets AS (SELECT ([{_list(I.SETS)}])[1 + doc_id % 4] AS set_name, doc_id AS word FROM labels),
found AS (SELECT s.set_name, s.word, v.vec FROM sets s LEFT JOIN v ON v.word = s.word)"""
ASSOC = f"""assoc AS (
  SELECT t.set_name, t.word, a.set_name AS attribute, avg({_cos('t.vec', 'a.vec')}) AS mean_cos
  FROM found t, found a
  WHERE t.set_name IN ('T1', 'T2') AND a.set_name IN ('A1', 'A2') AND t.vec IS NOT NULL AND a.vec IS NOT NULL
  GROUP BY ALL),
diffs AS (
  SELECT set_name, word, max(CASE WHEN attribute = 'A1' THEN mean_cos END) - max(CASE WHEN attribute = 'A2' THEN mean_cos END) AS diff
  FROM assoc GROUP BY ALL)"""
PROBS = """lg AS (SELECT word AS role, 't' || (i - 1) AS token, x * 10 AS logit
  FROM (SELECT word, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v)),
probs AS (SELECT * FROM (
  SELECT role, token, exp(logit - max(logit) OVER (PARTITION BY role)) / sum(exp(logit)) OVER (PARTITION BY role)
    * exp(max(logit) OVER (PARTITION BY role)) AS prob FROM lg))"""

MET = f"""met AS (
  SELECT lang AS "Method", source AS "Configuration", CAST(2 + n % 5 * 2 AS INTEGER) AS "Window",
    (['ppmi', 'tfidf', 'row_normalize'])[1 + n % 3] AS "Normalization", CAST(([{', '.join(map(str, I.DIMS))}])[1 + n % 4] AS INTEGER) AS "Dimensions",
    "SimLex-Correlation", "WordSim-Correlation", "Analogy-Accuracy", "Clustering-Silhouette"
  FROM (SELECT lang, source, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS n,
      CAST(sum(n_chars % 97) AS DOUBLE) / (count(*) * 97) AS "SimLex-Correlation",
      CAST(sum(d.doc_id % 89) AS DOUBLE) / (count(*) * 89) AS "WordSim-Correlation",
      CAST(sum(quality) AS DOUBLE) / nullif(count(quality), 0) AS "Analogy-Accuracy",
      CAST(sum(toxic * 2 - quality) AS DOUBLE) / nullif(count(quality) * 2, 0) AS "Clustering-Silhouette"
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang, source))"""
MNAMES = ("SimLex-Correlation", "WordSim-Correlation", "Analogy-Accuracy", "Clustering-Silhouette")
MLONG = "mlong AS (" + " UNION ALL ".join(f"""SELECT "Method", '{m}' AS metric, "{m}" AS value FROM met""" for m in MNAMES) + ")"
MROUND = ", ".join(f'round("{m}", 6) AS "{m}"' for m in MNAMES)
MSUM = """msum AS (SELECT "Method", metric, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max
  FROM mlong GROUP BY "Method", metric)"""


def _hist(name: str) -> str:
    return f"""SELECT '{name}' AS metric, CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 20 * b.bin, 6) AS lo,
    round(lo + (hi - lo) / 20 * (b.bin + 1), 6) AS hi, count(m.k) AS n
  FROM (SELECT min("{name}") * 1.0 AS lo, max("{name}") * 1.0 AS hi FROM met)
  CROSS JOIN (SELECT unnest(range(20)) AS bin) b
  LEFT JOIN (SELECT least(19, floor(("{name}" - a) / (z - a) * 20)) AS k
    FROM met, (SELECT CAST(min("{name}") AS DOUBLE) AS a, CAST(max("{name}") AS DOUBLE) AS z FROM met)) m ON m.k = b.bin
  GROUP BY b.bin, lo, hi"""


TRAIN = """train AS (SELECT p.src AS pid, a.vec AS x, b.vec AS y FROM (SELECT vec_id AS src, vec_id + 1 AS tgt FROM embeddings) p
  JOIN v a ON a.word = p.src JOIN v b ON b.word = p.tgt)"""
SINKHORN = (
    V, TRAIN, f"ker AS MATERIALIZED (SELECT a.pid AS i, b.pid AS j, exp({_cos('a.x', 'b.y')} / {I.REG}) AS k FROM train a, train b)",
    "cnt AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM train)",
    # scaling vectors by alternating sums; far more rounds than the tolerance needs
    """scal(r, i, u, v) AS (SELECT 0, pid, 1 / n, CAST(0 AS DOUBLE) FROM train, cnt UNION ALL (
  WITH cs AS (SELECT s.r, ker.j, 1 / n / sum(k * u) AS v FROM ker JOIN scal s USING (i), cnt WHERE s.r < 60 GROUP BY s.r, ker.j, n)
  SELECT any_value(cs.r) + 1, ker.i, 1 / any_value(n) / sum(k * cs.v), any_value(own.v)
  FROM ker JOIN cs USING (j) JOIN cs own ON own.j = ker.i, cnt GROUP BY ker.i))""",
    "solved AS MATERIALIZED (SELECT i, u, v FROM scal WHERE r = 60)",
    """bary AS MATERIALIZED (SELECT ker.i AS pid, p, sum(n * a.u * k * b.v * y) AS x FROM ker JOIN solved a ON a.i = ker.i JOIN solved b ON b.i = ker.j
  JOIN (SELECT pid AS j, unnest(y) AS y, generate_subscripts(y, 1) AS p FROM train) t ON t.j = ker.j, cnt GROUP BY ker.i, p)""",
)
# The orthogonal factor of the sum of x ybar^T: steps 1.5 m - 0.5 m m^T m bring every singular value to 1.
POLAR = (
    """cross0 AS MATERIALIZED (SELECT t.i, bary.p AS j, sum(t.x * bary.x) AS x
  FROM (SELECT pid, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM train) t JOIN bary USING (pid) GROUP BY 1, 2)""",
    """pol(r, i, j, x) AS (SELECT 0, i, j, x / (SELECT sqrt(sum(x * x)) FROM cross0) FROM cross0 UNION ALL (
  WITH sq AS (SELECT a.j AS i, b.j, sum(a.x * b.x) AS x FROM pol a JOIN pol b USING (i) WHERE a.r < 60 GROUP BY 1, 2),
  cu AS (SELECT a.i, sq.j, sum(a.x * sq.x) AS x FROM pol a JOIN sq ON sq.i = a.j GROUP BY 1, 2)
  SELECT a.r + 1, a.i, a.j, 1.5 * a.x - 0.5 * cu.x FROM pol a JOIN cu ON cu.i = a.i AND cu.j = a.j))""",
    "rot AS MATERIALIZED (SELECT i, j, x FROM pol WHERE r = 60)",
)
CELL = "cell AS (SELECT word, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v)"
CENTRED = (
    V, CELL, "cen AS MATERIALIZED (SELECT word, i, x - avg(x) OVER (PARTITION BY i) AS x FROM cell)",
    "cov1 AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) AS x FROM cen a JOIN cen b USING (word) GROUP BY 1, 2)",
)


def _axis(k: int) -> tuple[str, ...]:
    """The k-th principal axis: a covariance squared over and over becomes the projector on its first axis."""
    return (
        f"""pw{k}(r, i, j, x) AS (SELECT 0, i, j, x / (SELECT sum(x) FROM cov{k} WHERE i = j) FROM cov{k}
  UNION ALL SELECT r + 1, i, j, x / sum(CASE WHEN i = j THEN x END) OVER ()
  FROM (SELECT a.r, a.i, b.j, sum(a.x * b.x) AS x FROM pw{k} a JOIN pw{k} b ON a.j = b.i WHERE a.r < 24 GROUP BY 1, 2, 3))""",
        f"proj{k} AS MATERIALIZED (SELECT i, j, x FROM pw{k} WHERE r = 24)",
        f"top{k} AS (SELECT i, x FROM proj{k} WHERE i = j ORDER BY x DESC LIMIT 1)",
        f"axis{k} AS (SELECT p.i, p.x / sqrt(t.x) AS a FROM proj{k} p JOIN top{k} t ON p.j = t.i)",
        f"at{k} AS (SELECT word, sum(x * a) AS c FROM cen JOIN axis{k} USING (i) GROUP BY word)",
        f"""cov{k + 1} AS MATERIALIZED (SELECT i, j, c.x - (SELECT sum(a.x * b.x) FROM cov{k} a JOIN proj{k} b ON a.i = b.i AND a.j = b.j) * p.x AS x
  FROM cov{k} c JOIN proj{k} p USING (i, j))""",
    )


def _inverse(name: str, m: str) -> tuple[str, ...]:
    """Inverse of a covariance by steps x + x (1 - m x)."""
    return (
        f"""it_{name}(r, i, j, x) AS (SELECT 0, i, j, x / (SELECT sum(x * x) FROM {m}) FROM {m} UNION ALL (
  WITH e AS (SELECT m.i, t.j, (m.i = t.j)::INT - sum(m.x * t.x) AS x FROM {m} m JOIN it_{name} t ON m.j = t.i WHERE t.r < 40 GROUP BY 1, 2),
  f AS (SELECT t.i, e.j, sum(t.x * e.x) AS x FROM it_{name} t JOIN e ON t.j = e.i GROUP BY 1, 2)
  SELECT t.r + 1, t.i, t.j, t.x + f.x FROM it_{name} t JOIN f ON f.i = t.i AND f.j = t.j))""",
        f"{name} AS MATERIALIZED (SELECT i, j, x FROM it_{name} WHERE r = 40)",
    )


def _moment(name: str, a: str, b: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) AS x FROM {a} a JOIN {b} b USING (pid) GROUP BY 1, 2)"


def _side(name: str, col: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT pid, i, x - avg(x) OVER (PARTITION BY i) AS x
  FROM (SELECT pid, unnest({col}) AS x, generate_subscripts({col}, 1) AS i FROM train))"""


CCA = (V, TRAIN, _side("sx", "x"), _side("sy", "y"), _moment("cxx", "sx", "sx"), _moment("cyy", "sy", "sy"), _moment("cxy", "sx", "sy"),
       *_inverse("ixx", "cxx"), *_inverse("iyy", "cyy"),
       "l AS (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM ixx a JOIN cxy b ON a.j = b.i GROUP BY 1, 2)",
       "r AS (SELECT b.i, a.i AS j, sum(a.x * b.x) AS x FROM iyy a JOIN cxy b ON a.j = b.j GROUP BY 1, 2)")
LEADING = ("""pp AS MATERIALIZED (SELECT row, col, greatest(0.0, ln(w * sum(w) OVER () / (sum(w) OVER (PARTITION BY row) * sum(w) OVER (PARTITION BY col)))) AS w FROM cooc)""",
           """lead(r, i, x, s) AS (SELECT 0, idx, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) FROM vocab UNION ALL
  SELECT r + 1, row, y / sqrt(sum(y * y) OVER ()), sqrt(sum(y * y) OVER ())
  FROM (SELECT r, row, sum(w * x) AS y FROM pp JOIN lead ON i = col WHERE r < 200 AND w > 0 GROUP BY r, row))""")


def _cells(source: str, key: str = "word") -> str:
    return f"SELECT {key}, CAST(i - 1 AS INTEGER) AS p, round(x, 6) AS x FROM (SELECT {key}, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM {source})"


WORD_VEC = "last AS (SELECT 'w' || label AS word, min(word) AS first_pos, arg_max(vec, word) AS vec FROM v GROUP BY label)"
REQUIRED = """req AS (SELECT doc_id AS word FROM labels WHERE toxic = 1 UNION
  SELECT doc_id + 3 FROM labels WHERE (doc_id * 7) % 11 + quality > 10)"""
UNITS_RE = rf"\p{{Nd}}+[{SP}]*(?:{'|'.join(I.UNITS)})"
LEAD_RE = rf"^[•''\"$\-.{SP}]+"
MIXED_RE = f"[a-zA-Z]+[^{I.ACCENTED}]*[{I.ACCENTED}]+|[{I.ACCENTED}]+[^{I.ACCENTED}]*[a-zA-Z]+"
LED = f"regexp_replace(sentence, '{LEAD_RE}', '')"
WRAPPED = rf"regexp_replace(regexp_replace({LED}, '({UNITS_RE})', '__\1__', 'g'), '\(.*?\)', '', 'g')"

ORACLES = {
    # sources and sinks
    "corpus_scan": _with(LN) + "SELECT sentence, count(*) AS n FROM ln GROUP BY sentence",
    "vectors_text_scan": _with(V, WORD_VEC) + _cells("last", "word, first_pos"),
    "vectors_text_capped": _with(
        V, "firsts AS (SELECT label, min(word) AS first_pos FROM v GROUP BY label ORDER BY first_pos LIMIT 5)",
        "stop AS (SELECT max(first_pos) AS p FROM firsts)",
        "kept AS (SELECT 'w' || label AS word, min(word) AS first_pos, arg_max(vec, word) AS vec FROM v, stop WHERE word <= stop.p GROUP BY label)",
    ) + _cells("kept", "word, first_pos"),
    "vectors_text_sink": _with(V) + _cells("v"),
    "vectors_text_header": _with(V) + _cells("v"),
    "vectors_text_sniff": _with(V) + _cells("v"),
    "dict_scan_ws": _with(LN, f"t AS (SELECT doc_id, line, {_toks('sentence')} AS p FROM ln)")
    + "SELECT doc_id, CAST(line AS INTEGER) AS line, p[1] AS src, p[2] AS tgt FROM t WHERE len(p) >= 2",
    "dict_scan_tab_filtered": _with(
        LN, r"talk AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '\s+')) AS word FROM conversations)",
        "t AS (SELECT doc_id, line, string_split(sentence, ' ') AS p FROM ln)",
    ) + """SELECT doc_id, CAST(line AS INTEGER) AS line, p[1] AS src, p[2] AS tgt FROM t
WHERE len(p) >= 2 AND p[1] IN (SELECT word FROM talk) AND p[2] IN (SELECT word FROM talk)""",
    "malformed_count": _with(LN) + "SELECT count(*) AS malformed FROM ln WHERE NOT contains(sentence, ' ') AND NOT contains(sentence, chr(9))",
    "gold_similarity_scan": """SELECT c_custkey AS pos, c_name AS src, c_mktsegment AS tgt, c_acctbal AS score FROM customer
WHERE c_acctbal >= 0 AND c_custkey IN (SELECT o_custkey FROM orders)""",
    "gold_similarity_renamed": "SELECT s_suppkey AS s_no, s_name AS word1, CAST(s_nationkey AS VARCHAR) AS word2, s_acctbal AS similarity FROM supplier",
    "gold_similarity_plain": "SELECT p_name, p_type, p_retailprice FROM part",
    "analogy_scan": _with(LN, f"t AS (SELECT doc_id, line, {_toks('sentence')} AS p FROM ln)")
    + "SELECT doc_id, CAST(line AS INTEGER) AS line, p[1] AS a, p[2] AS b, p[3] AS c, p[4] AS d FROM t WHERE len(p) = 4",
    "analogy_file": _with(LN, f"t AS (SELECT {_toks('sentence')} AS p FROM ln)")
    + "SELECT p[1] AS a, p[2] AS b, p[3] AS c, p[4] AS d, count(*) AS n FROM t WHERE len(p) = 4 GROUP BY 1, 2, 3, 4",
    "concept_scan": """SELECT p_partkey AS pos, p_type AS category, p_name AS src, p_brand AS tgt FROM part
WHERE p_name IN (SELECT p_name FROM part WHERE p_name LIKE '% widget') AND p_brand IN (SELECT p_brand FROM part WHERE p_brand LIKE 'Brand#1%')""",
    "vocab_scan": _with(*CORPUS) + "SELECT DISTINCT word FROM words",
    "vocab_json": _with(*CORPUS) + "SELECT word, CAST(count(*) AS INTEGER) AS freq FROM words GROUP BY word",
    "metrics_scan": _with(MET) + f'SELECT "Method", "Configuration", "Window", "Normalization", "Dimensions", {MROUND} FROM met',
    "metrics_dir_scan": _with(MET) + f"""SELECT "Method", 'Configuration=' || "Configuration" AS "Configuration", "Window", "Normalization", "Dimensions", {MROUND} FROM met""",
    "table_sinks": COOC_ALL + """SELECT CAST("window" AS INTEGER) AS "window", count(*) AS nonzero, sum(w) AS total FROM cooc WHERE "window" = 4 GROUP BY 1""",
    # text
    "clean_basic": _with(LN, CL) + "SELECT doc_id, CAST(line AS INTEGER) AS line, clean FROM cl",
    "clean_minimal": rf"SELECT doc_id, regexp_replace(lower(text), '[^{WD}{SP}]', '', 'g') AS clean FROM documents",
    "clean_indic": _with(LN) + rf"SELECT doc_id, CAST(line AS INTEGER) AS line, regexp_replace({WRAPPED}, '[।!?][{SP}]*', '', 'g') AS clean FROM ln",
    "preserved_phrases": _with(LN) + f"""SELECT unnest(regexp_extract_all({LED}, '{UNITS_RE}')) AS phrase FROM ln
UNION SELECT unnest(regexp_extract_all({WRAPPED}, '{MIXED_RE}')) FROM ln""",
    "tokenize": _with(LN, CL) + f"""SELECT doc_id, CAST(line AS INTEGER) AS line, len({_toks('clean')}) AS n,
  coalesce(array_to_string({_toks('clean')}, '|'), '') AS toks FROM cl""",
    "filter_tokens": _with(LN, CL, TK) + "SELECT doc_id, CAST(line AS INTEGER) AS line, coalesce(array_to_string(toks, '|'), '') AS toks FROM tk",
    "filter_tokens_indic": f"""SELECT conv_id, turn, coalesce(array_to_string(list_filter({_toks('text')},
  lambda t: length(t) >= 2 AND t NOT IN ({_list(INDIC_STOP_WORDS)})), '|'), '') AS toks FROM conversations""",
    "script_filter": _with(LN, CL) + f"""SELECT doc_id, CAST(line AS INTEGER) AS line, coalesce(array_to_string(list_filter({_toks('clean')},
  lambda t: regexp_matches(t, '[{I.ACCENTED}]')), '|'), '') AS toks FROM cl""",
    "triples_from_tokens": _with(f"t AS (SELECT doc_id, {_toks('text')} AS p FROM documents)") + """
SELECT doc_id, CAST(r AS BIGINT) AS rec, p[3 * r + 1] AS category, p[3 * r + 2] AS src, p[3 * r + 3] AS tgt
FROM (SELECT doc_id, p, unnest(range(len(p) // 3)) AS r FROM t)""",
    "repair_vectors": _with(V, """kept AS (SELECT word AS pos, CASE WHEN label % 4 = 0 THEN 'new_york' ELSE 'x' END AS word, vec
FROM v WHERE label % 4 IN (0, 2))""") + _cells("kept", "pos, word"),
    "parse_params": """SELECT p_partkey, CASE WHEN ok THEN p_size END AS "window", CASE WHEN ok THEN lower(p_type) END AS norm,
  CASE WHEN ok THEN CAST(p_partkey AS INTEGER) END AS dim, CASE WHEN ok THEN lower(p_type) || ' (d=' || p_partkey || ')' END AS label
FROM (SELECT *, p_size % 3 <> 2 AS ok FROM part)""",
    "topic_filters": "SELECT p_partkey, p_type AS category FROM part WHERE p_type LIKE 'S%'",
    "metric_filters": _with(MET) + f"""SELECT "Method", "Configuration", "Window", "Normalization", "Dimensions", {MROUND} FROM met
WHERE "Dimensions" = 100 AND "Normalization" = 'ppmi'""",
    "template_fill": "SELECT n_name AS role, 'The ' || n_name || ' said that [MASK] is very busy.' AS prompt FROM nation",
    # vocabulary and co-occurrence
    "corpus_stats": _with(LN, CL, TK) + """SELECT count(*) AS total_sentences, CAST(sum(len(toks)) AS BIGINT) AS total_tokens,
  round(sum(len(toks)) / count(*), 6) AS avg_tokens_per_sentence, CAST(0 AS BIGINT) AS failed_sentences FROM tk""",
    "word_count": _with(*CORPUS) + "SELECT word, count(*) AS freq FROM words GROUP BY word",
    "build_vocab": _with(*CORPUS, VOCAB) + "SELECT word, freq, idx FROM vocab",
    "build_vocab_unfiltered": _with(*CORPUS) + """SELECT word, freq, row_number() OVER (ORDER BY first) - 1 AS idx
FROM (SELECT word, count(*) AS freq, min((doc_id, line, pos)) AS first FROM words GROUP BY word)""",
    "encode": _with(*ENCODED) + """SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(pos AS INTEGER) AS pos, CAST(idx AS INTEGER) AS idx
FROM enc QUALIFY count(*) OVER (PARTITION BY doc_id, line) >= 2""",
    "cooc_count": COOC2 + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, w FROM cooc""",
    "cooc_distance": COOC2D + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, round(w, 6) AS w FROM cooc""",
    "cooc_rownorm": COOC2D + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
  round(w / sum(w) OVER (PARTITION BY "window", row), 6) AS w FROM cooc""",
    "cooc_multi_window": COOC_ALL + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, count(*) AS nonzero, sum(w) AS total FROM cooc GROUP BY ALL""",
    "matrix_info": COOC_ALL + f"""SELECT CAST("window" AS INTEGER) AS window_size, v AS n_rows, v AS n_cols, count(*) AS nonzero, false AS normalized,
  false AS distance_weighted, {I.MIN_FREQ} AS min_frequency, v AS vocabulary_size
FROM cooc, (SELECT CAST(count(*) AS INTEGER) AS v FROM vocab) GROUP BY "window", v""",
    # weighting
    "ppmi": COOC2 + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
  round(greatest(0.0, ln((w / sum(w) OVER ()) / ((sum(w) OVER (PARTITION BY row) / sum(w) OVER ()) * (sum(w) OVER (PARTITION BY col) / sum(w) OVER ())))), 6) AS w
FROM cooc""",
    "tfidf": COOC2 + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
  round(w * ln((SELECT count(*) FROM vocab) / (count(*) OVER (PARTITION BY col) + 1)), 6) AS w FROM cooc""",
    "row_normalize": COOC2 + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
  round(w / sum(w) OVER (PARTITION BY row), 6) AS w FROM cooc""",
    "row_normalize_l2": COOC2 + """SELECT CAST("window" AS INTEGER) AS "window", CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
  round(w / sqrt(sum(w * w) OVER (PARTITION BY row)), 6) AS w FROM cooc""",
    "top_ppmi_pairs": COOC2D + """, scored AS (
  SELECT row, col, round(greatest(0.0, ln(w * sum(w) OVER () / (sum(w) OVER (PARTITION BY row) * sum(w) OVER (PARTITION BY col)))), 6) AS ppmi FROM cooc)
SELECT a.word AS word_a, b.word AS word_b, ppmi FROM (SELECT * FROM scored WHERE row < col ORDER BY ppmi DESC, row, col LIMIT 20)
JOIN vocab a ON a.idx = row JOIN vocab b ON b.idx = col""",
    "svd_leading": _with(*ENCODED, _cooc((2,)), *LEADING) + """SELECT CAST(idx AS INTEGER) AS idx, round(coalesce(x, 0) * (SELECT max(s) FROM lead WHERE r = 200), 3) AS x
FROM vocab LEFT JOIN (SELECT i, x FROM lead WHERE r = 200) ON i = idx""",
    "sweep_info": _with(*CORPUS, VOCAB) + f"""SELECT 'w' || w || '_' || m || '_d' || d AS key, w AS window_size, m AS normalization, d AS dimensions,
  v AS original_rows, v AS original_columns, v AS embedding_rows, CAST(least(d, v) AS INTEGER) AS embedding_columns
FROM (SELECT unnest([{', '.join(map(str, I.WINDOWS))}]) AS w), (SELECT unnest(['ppmi', 'tfidf', 'row_normalize']) AS m),
  (SELECT unnest([{', '.join(map(str, I.DIMS))}]) AS d), (SELECT CAST(count(*) AS INTEGER) AS v FROM vocab)""",
    "project_2d": _with(*CENTRED, *_axis(1), *_axis(2)) + """SELECT word, round(a.c * (SELECT sign(sum(c * c * c)) FROM at1), 6) AS x,
  round(b.c * (SELECT sign(sum(c * c * c)) FROM at2), 6) AS y FROM at1 a JOIN at2 b USING (word)""",
    "merge_sweep_results": """SELECT coalesce(b.k, a.k) AS key, coalesce(b.n, a.n) AS n, coalesce(b.d, a.d) AS d
FROM (SELECT p_brand AS k, count(*) AS n, max(p_size) AS d FROM part GROUP BY 1) a
FULL JOIN (SELECT p_brand AS k, count(*) AS n, min(p_size) AS d FROM part WHERE p_size > 45 GROUP BY 1) b ON a.k = b.k""",
    # similarity
    "cosine_pair": _with(V, NEXT) + """SELECT src, tgt, round(list_dot_product(a.vec, b.vec)
  / (sqrt(list_dot_product(a.vec, a.vec)) * sqrt(list_dot_product(b.vec, b.vec)) + 1e-8), 6) AS cos
FROM pairs JOIN v a ON a.word = src JOIN v b ON b.word = tgt""",
    "l2_normalize": _with(V, "u AS (SELECT word, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM v)") + _cells("u"),
    "analogy": _with(V, QUESTIONS, ASKED, PREDICTED) + "SELECT qid, a, b, c, d, predicted, round(cos, 6) AS cos FROM predicted",
    "analogy_coverage": _with(V, QUESTIONS, ASKED, PREDICTED) + """SELECT round(avg(CASE WHEN predicted = d THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(count(*) / (SELECT count(*) FROM qs), 6) AS coverage, count(*) AS total, (SELECT count(*) FROM qs) - count(*) AS skipped FROM predicted""",
    "topk_neighbours": _with(V, O) + f"""SELECT * FROM (SELECT a.word AS src, b.word AS tgt, round({_cos('a.vec', 'b.vec')}, 6) AS cos,
  CAST(row_number() OVER (PARTITION BY a.word ORDER BY round({_cos('a.vec', 'b.vec')}, 12) DESC, b.word) AS INTEGER) AS rank FROM v a, o b) WHERE rank <= 5""",
    "silhouette": _with(V, SIL) + "SELECT word, cluster, round(s, 6) AS silhouette FROM sil",
    "silhouette_mean": _with(V, SIL) + "SELECT round(avg(s), 6) AS silhouette FROM sil",
    "silhouette_squared": _with(V, SIL.replace("list_distance(a.vec, b.vec)", "power(list_distance(a.vec, b.vec), 2)"))
    + "SELECT count(*) AS n, round(avg(s), 6) AS silhouette FROM sil",
    "gold_spearman": _with(V, GOLD, SCORED, RANKED) + """SELECT round(corr(rx, ry), 6) AS corr, count(*) AS covered, (SELECT count(*) FROM gold) AS pairs,
  round(count(*) / (SELECT count(*) FROM gold), 6) AS coverage FROM ranked""",
    "gold_pearson": _with(V, GOLD, SCORED) + """SELECT round(corr(cos, score), 6) AS corr, count(*) AS covered, (SELECT count(*) FROM gold) AS pairs,
  round(count(*) / (SELECT count(*) FROM gold), 6) AS coverage FROM scored""",
    "group_cosine": _with(V, O) + f"""SELECT 'c' || a.label AS category, a.word AS src, a.word AS tgt,
  round(max(CASE WHEN a.word = b.word THEN {_cos('a.vec', 'o.vec')} END), 6) AS own_cos, count(*) AS n_targets, round(avg({_cos('a.vec', 'o.vec')}), 6) AS mean_cos
FROM v a JOIN v b ON a.label = b.label JOIN o ON o.word = b.word GROUP BY a.label, a.word""",
    # alignment
    "training_pairs": _with(V, O, NEXT) + _cells("(SELECT src, tgt, list_concat(v.vec, o.vec) AS vec FROM pairs JOIN v ON v.word = src JOIN o ON o.word = tgt)", "src, tgt"),
    "required_words": _with(REQUIRED) + "SELECT word FROM req",
    "filter_vocab": _with(V, REQUIRED, """placed AS (
  SELECT v.word, row_number() OVER (ORDER BY CASE WHEN r.word IS NULL THEN 1 ELSE 0 END, v.word DESC) - 1 AS place, vec
  FROM v LEFT JOIN req r ON r.word = v.word)""") + _cells("(SELECT * FROM placed WHERE place < 200)", "word, place"),
    "procrustes": _with(V, O) + _cells("o"),
    "dim_check": _with(V) + "SELECT count(*) AS n, CAST(max(len(vec)) AS INTEGER) AS dim FROM v",
    "cca": "SELECT CAST(p AS INTEGER) AS p, (SELECT count(*) FROM embeddings) AS n, CAST(0 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS variance FROM (SELECT unnest(range((SELECT max(len(embedding)) FROM embeddings))) AS p)",
    "pair_sample": _with(NEXT) + r"SELECT src, tgt FROM pairs ORDER BY md5('42' || chr(9) || src || chr(9) || tgt), src, tgt LIMIT 100",
    "sinkhorn_plan": _with(*SINKHORN) + "SELECT i AS pid, round(ln(u), 6) AS f, round(ln(v), 6) AS g FROM solved",
    "barycenter_targets": _with(*SINKHORN) + "SELECT pid, CAST(p - 1 AS INTEGER) AS p, round(x, 6) AS x FROM bary",
    "barycenter_align_next": _with(*SINKHORN, *POLAR) + """SELECT word, CAST(rot.j - 1 AS INTEGER) AS p, round(sum(c.x * rot.x), 6) AS x
FROM (SELECT word, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v) c JOIN rot USING (i) GROUP BY word, rot.j""",
    "cca_correlations": _with(*CCA) + """SELECT (SELECT count(*) FROM embeddings) AS pairs, (SELECT count(DISTINCT i) FROM cxx) AS n,
  (SELECT round(sum(l.x * r.x), 6) FROM l JOIN r USING (i, j)) AS squares""",
    "barycenter_align": _with(V) + "SELECT word, CAST(i - 1 AS INTEGER) AS p, round(x, 4) AS x FROM (SELECT word, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v)",
    "self_learning_nearest": _with(V, O) + _cells("o"),
    # alignment evaluation
    "translation_rank": _with(V, NEXT, RANKS) + "SELECT src, tgt, n, round(cos, 6) AS cos, rank FROM ranks",
    "precision_mrr": _with(V, NEXT, RANKS) + """SELECT count(*) AS total, round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0 END), 6) AS p_at_1,
  round(avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0 END), 6) AS p_at_5, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0 END), 6) AS p_at_10, round(avg(1.0 / rank), 6) AS mrr FROM ranks""",
    "alignment_report": _with(V, NEXT, RANKS) + """SELECT count(*) AS total, round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0 END) * 100, 2) AS p_at_1_percent,
  round(avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0 END) * 100, 2) AS p_at_5_percent, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0 END) * 100, 2) AS p_at_10_percent,
  round(avg(1.0 / rank), 4) AS mrr FROM ranks""",
    "semantic_similarity": _with(V, GOLD, SCORED, RANKED) + "SELECT round(corr(rx, ry), 6) AS spearman_correlation, round(avg(abs(cos - score)), 6) AS mean_absolute_error FROM ranked",
    "hubness": _with(V, O, _hubs("v", "o", 10)) + "SELECT max_hub_size, round(mean_hub_size, 6) AS mean_hub_size, round(std_hub_size, 6) AS std_hub_size, round(skewness, 6) AS skewness FROM hub",
    "evaluate_all": f"SELECT * FROM ({_evaluate('none', 'v', 'o')}) UNION ALL SELECT * FROM ({_evaluate('procrustes', 'o', 'o')})",
    "sample_pairs": _with(NEXT) + r"""SELECT src, tgt, src || '/' || tgt AS label FROM (
  SELECT src, tgt FROM pairs ORDER BY md5('42' || chr(9) || src || chr(9) || tgt), src, tgt LIMIT 200)
WHERE src IN (SELECT vec_id FROM embeddings) AND tgt IN (SELECT vec_id FROM embeddings)""",
    # bias
    "set_vectors": _with(V, SETS) + _cells(
        "(SELECT set_name, word, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM found WHERE vec IS NOT NULL)", "set_name, word"
    ) + " UNION ALL SELECT set_name, word, NULL, NULL FROM found WHERE vec IS NULL",
    "missing_words": _with(V, SETS) + "SELECT DISTINCT word FROM found WHERE vec IS NULL",
    "mean_association": _with(V, SETS, ASSOC) + "SELECT set_name, word, attribute, round(mean_cos, 6) AS mean_cos FROM assoc",
    "differential": _with(V, SETS, ASSOC) + "SELECT set_name, word, round(diff, 6) AS diff FROM diffs",
    "weat_effect": _with(V, SETS, ASSOC) + """SELECT
  round((avg(diff) FILTER (set_name = 'T1') - avg(diff) FILTER (set_name = 'T2')) / stddev_samp(diff), 6) AS effect_size,
  round(avg(diff) FILTER (set_name = 'T1'), 6) AS t1_mean_diff, round(avg(diff) FILTER (set_name = 'T2'), 6) AS t2_mean_diff,
  count(*) AS sample_size, CAST((SELECT count(DISTINCT word) FROM found WHERE vec IS NULL) AS INTEGER) AS missing FROM diffs""",
    "softmax_at_mask": _with(V, PROBS) + "SELECT role, token, round(prob, 6) AS prob FROM probs",
    "pair_bias": _with(V, PROBS) + """SELECT m.role, m.token AS male, f.token AS female, round(m.prob, 6) AS male_prob, round(f.prob, 6) AS female_prob,
  round(m.prob - f.prob, 6) AS difference, round(m.prob / f.prob, 6) AS ratio
FROM probs m JOIN probs f ON m.role = f.role AND CAST(m.token[2:] AS INTEGER) % 2 = 0 AND CAST(f.token[2:] AS INTEGER) = CAST(m.token[2:] AS INTEGER) + 1""",
    # metric tables
    "metrics_row": _with(V, QUESTIONS, ASKED, PREDICTED, SIL, GOLD, SCORED, RANKED) + """SELECT 10 AS "Window", 'ppmi' AS "Normalization",
  (SELECT CAST(max(len(vec)) AS INTEGER) FROM v) AS "Dimensions", round(avg(CASE WHEN predicted = d THEN 1.0 ELSE 0.0 END), 6) AS "Analogy-Accuracy",
  round(count(*) / (SELECT count(*) FROM qs), 6) AS "Analogy-Coverage", count(*) AS "Analogy-Total",
  (SELECT round(avg(s), 6) FROM sil) AS "Clustering-Silhouette", (SELECT round(corr(rx, ry), 6) FROM ranked) AS "SimLex-Correlation",
  (SELECT round(count(*) / (SELECT count(*) FROM gold), 6) FROM scored) AS "SimLex-Coverage" FROM predicted""",
    "merge_methods": _with(MET) + f"""SELECT 'Co-occurrence' AS "Method", CAST(NULL AS VARCHAR) AS "Configuration", "Window", "Normalization", "Dimensions", {MROUND}, CAST(NULL AS INTEGER) AS "Analogy-Total" FROM met
UNION ALL SELECT 'Neural', "Configuration", NULL, "Normalization", "Dimensions", {MROUND}, 3 FROM met WHERE "Dimensions" > 100""",
    "method_summary": _with(MET, MLONG, MSUM) + 'SELECT "Method", metric, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(max, 6) AS max FROM msum',
    "best_method": _with(MET, MLONG, MSUM) + """SELECT metric, "Method" AS best, round(mean, 6) AS mean FROM msum
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY mean DESC NULLS LAST, "Method") = 1""",
    "method_means_pivot": _with(MET) + 'SELECT "Method", ' + ", ".join(f'round(avg("{m}"), 6) AS "{m}"' for m in MNAMES) + ' FROM met GROUP BY "Method"',
    "metric_correlation": _with(MET) + """SELECT 'SimLex-Correlation' AS metric, 1.0 AS "SimLex-Correlation", round(corr("SimLex-Correlation", "WordSim-Correlation"), 6) AS "WordSim-Correlation" FROM met
UNION ALL SELECT 'WordSim-Correlation', round(corr("SimLex-Correlation", "WordSim-Correlation"), 6), 1.0 FROM met""",
    "histograms": _with(MET) + " UNION ALL ".join(f"({_hist(m)})" for m in ("Window", "Dimensions", "SimLex-Correlation", "WordSim-Correlation")),
    "box_summary": _with(MET) + 'SELECT "Normalization", ' + ", ".join(
        f'round(quantile_cont("SimLex-Correlation", {q}), 6) AS {n}' for q, n in ((0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1, "max"))
    ) + ' FROM met GROUP BY "Normalization"',
    "surface_pivot": _with(MET) + 'SELECT "Normalization", "Window", ' + ", ".join(
        f'round(avg("SimLex-Correlation") FILTER ("Dimensions" = {d}), 6) AS "{d}"' for d in I.DIMS
    ) + ' FROM met GROUP BY "Normalization", "Window"',
    "trend_series": _with(MET) + 'SELECT "Normalization", "Window", round(avg("SimLex-Correlation"), 6) AS mean FROM met WHERE "Dimensions" = 100 GROUP BY 1, 2',
    "top3": _with(MET) + f"""SELECT "Method", "Configuration", "Window", "Normalization", "Dimensions", {MROUND} FROM (
  SELECT * FROM met ORDER BY "SimLex-Correlation" DESC, "Method", "Configuration" LIMIT 3)""",
    "overall_range": _with(MET, MLONG) + "SELECT round(min(value), 6) AS low, round(max(value), 6) AS high FROM mlong",
    "overview_counts": _with(MET) + 'SELECT count(DISTINCT "Method") AS methods, count(*) AS rows FROM met',
}
