"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

import re
from importlib import resources

from narrata.plans import sqltext as Q

# Fixed values, stated here again so that the SQL shares no code with what it checks.
BOOSTER_INCREMENTS = (0.293, 0.293 * 0.95, 0.293 * 0.9)   # by distance 1, 2, 3
NEGATION = "-0.74"
BEFORE, AFTER = "0.5", "1.5"                              # around the contrast word
STOP_WORDS = resources.files("narrata.data").joinpath("stopwords_en.txt").read_text(encoding="utf-8").split()
BARE_STOP_WORDS = list(dict.fromkeys(w for w in (re.sub("[^a-z]", "", x.lower()) for x in STOP_WORDS) if w))

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


COMPLAINTS = Q.complaints_cte(True)
COMPLAINTS_NR = Q.complaints_cte(False)
CLEANED = Q.cleaned_cte(True)
CLEANED_NR = Q.cleaned_cte(False)
WC = ("wc AS (SELECT *, " + Q.word_count("narrative") + " AS word_count, "
      + Q.word_count("clean") + " AS clean_word_count FROM cleaned)")

# scored(complaint_id, product, valence_sum, compound, sentiment) on cleaned_nr
SCORED = (
    CLEANED_NR + Q.lexicon_ctes()
    + ", toks AS (SELECT complaint_id, unnest(" + Q.words("clean") + ") AS tok FROM cleaned)"
    + ", sums AS (SELECT t.complaint_id, sum(l.valence) AS s FROM toks t JOIN lex l "
      "ON l.token = t.tok GROUP BY t.complaint_id)"
    + ", scored0 AS (SELECT c.complaint_id, c.product, CAST(coalesce(s.s, 0) AS DOUBLE) AS valence_sum "
      "FROM cleaned c LEFT JOIN sums s ON s.complaint_id = c.complaint_id)"
    + ", scored AS (SELECT *, " + Q.compound("valence_sum") + " AS compound, "
    + Q.label(Q.compound("valence_sum")) + " AS sentiment FROM scored0)"
)
SENT_NAME = ("CASE sentiment WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' "
             "WHEN 2 THEN 'Positive' END")

# --- sentiment --------------------------------------------------------------

oracle("sentiment_by_product", "WITH " + SCORED + """
SELECT product,
  round(nullif(count(*) FILTER (WHERE sentiment = 0), 0) / count(*), 6) AS negative,
  round(nullif(count(*) FILTER (WHERE sentiment = 1), 0) / count(*), 6) AS neutral,
  round(nullif(count(*) FILTER (WHERE sentiment = 2), 0) / count(*), 6) AS positive
FROM scored GROUP BY product""")

oracle("lexicon_sentiment", "WITH " + SCORED + """
SELECT complaint_id, round(valence_sum, 6) AS valence_sum, round(compound, 6) AS compound, sentiment
FROM scored""")

oracle("sentiment_distribution", "WITH " + SCORED + f"""
, named AS (SELECT {SENT_NAME} AS sentiment FROM scored)
SELECT sentiment, count(*) AS count, round(count(*) / (SELECT count(*) FROM named), 6) AS share
FROM named GROUP BY sentiment""")


def _context_ctes(p: str, src: str, key: str) -> list[str]:
    """Context-rule scoring of ``src(key, clean)``; needs vocab and lex CTEs.

    Ends with ``{p}sc(key, valence_sum)`` for every row of ``src``.
    """
    steps = []
    prev = "v0"
    for d in (1, 2, 3):
        inc = repr(BOOSTER_INCREMENTS[d - 1])
        b = f"(bst{d} AND val{d} IS NULL)"
        n = f"(neg{d} AND val{d} IS NULL)"
        add = f"{prev} + CASE WHEN {b} THEN (CASE WHEN {prev} < 0 THEN -{inc} ELSE {inc} END) ELSE 0.0 END"
        steps.append(f"{p}s{d}a AS (SELECT *, {add} AS a{d} FROM {p + 's0' if d == 1 else f'{p}s{d-1}b'})")
        steps.append(f"{p}s{d}b AS (SELECT *, CASE WHEN {n} THEN a{d} * ({NEGATION}) "
                     f"ELSE a{d} END AS w{d} FROM {p}s{d}a)")
        prev = f"w{d}"
    lags = ", ".join(f"lag(val, {d}) OVER w AS val{d}, lag(neg, {d}) OVER w AS neg{d}, "
                     f"lag(bst, {d}) OVER w AS bst{d}" for d in (1, 2, 3))
    return [
        f"{p}tw AS (SELECT {key}, {Q.words('clean')} AS w FROM {src})",
        f"{p}toks AS (SELECT {key}, unnest(w) AS tok, generate_subscripts(w, 1) - 1 AS pos FROM {p}tw)",
        f"{p}cw AS (SELECT arg_min(token, md5(token)) AS token FROM vocab)",
        f"{p}r AS (SELECT t.{key}, t.pos, t.tok, l.valence AS val, "
        "(v.token IS NOT NULL AND substr(md5(t.tok), 1, 1) = '4') AS neg, "
        "(v.token IS NOT NULL AND substr(md5(t.tok), 1, 1) = '5') AS bst, "
        f"t.tok = (SELECT token FROM {p}cw) AS iscw FROM {p}toks t LEFT JOIN lex l ON l.token = t.tok "
        "LEFT JOIN vocab v ON v.token = t.tok)",
        f"{p}s0 AS (SELECT *, CASE WHEN bst THEN 0.0 ELSE val END AS v0, {lags}, "
        f"min(CASE WHEN iscw THEN pos END) OVER (PARTITION BY {key}) AS bi "
        f"FROM {p}r WINDOW w AS (PARTITION BY {key} ORDER BY pos))",
        *steps,
        f"{p}fin AS (SELECT {key}, CASE WHEN bi IS NULL THEN w3 WHEN pos < bi THEN w3 * "
        f"{BEFORE} WHEN pos > bi THEN w3 * {AFTER} ELSE w3 END AS v FROM {p}s3b)",
        f"{p}per AS (SELECT {key}, sum(CAST(round(v * 1e9) AS BIGINT)) / 1e9 AS s FROM {p}fin GROUP BY {key})",
        f"{p}sc AS (SELECT c.{key}, CAST(coalesce(x.s, 0) AS DOUBLE) AS valence_sum "
        f"FROM {src} c LEFT JOIN {p}per x ON x.{key} = c.{key})",
    ]


def _context_sql() -> str:
    return ("WITH " + CLEANED_NR + Q.lexicon_ctes() + ", " + ", ".join(_context_ctes("", "cleaned", "complaint_id"))
            + " SELECT complaint_id, round(valence_sum, 6) AS valence_sum, round("
            + Q.compound("valence_sum") + ", 6) AS compound, " + Q.label(Q.compound("valence_sum"))
            + " AS sentiment FROM sc")


oracle("lexicon_sentiment_context", _context_sql())

# --- cleaning ---------------------------------------------------------------

oracle("clean_narrative", with_(COMPLAINTS_NR)
       + f"SELECT complaint_id, {Q.clean('narrative')} AS clean FROM complaints")

oracle("word_counts", with_(COMPLAINTS_NR)
       + f"SELECT complaint_id, {Q.word_count('narrative')} AS word_count, "
       f"{Q.word_count(Q.clean('narrative'))} AS clean_word_count FROM complaints")

_STOPS = Q.sql_list(BARE_STOP_WORDS)
_letters = f"lower(regexp_replace(narrative, '[^a-zA-Z\\t-\\r\\x1c-\\x20\\x{{85}}\\p{{Z}}]', '', 'g'))"
oracle("strip_stopwords", with_(COMPLAINTS_NR)
       + f"SELECT complaint_id, array_to_string(list_filter({Q.words(_letters)}, "
       f"lambda x: NOT list_contains({_STOPS}, x)), ' ') AS processed_text FROM complaints")

# --- profiling --------------------------------------------------------------

_cols = ["complaint_id", "narrative", "product", "company", "issue", "response"]
oracle("null_counts", with_(COMPLAINTS) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM complaints"
    for c in _cols))

oracle("row_count", with_(CLEANED) + """
SELECT 'complaints' AS stage, count(*) AS row_count FROM complaints
UNION ALL SELECT 'cleaned', count(*) FROM cleaned
UNION ALL SELECT 'complete', count(*) FROM complaints WHERE narrative IS NOT NULL AND product IS NOT NULL
  AND company IS NOT NULL AND issue IS NOT NULL AND response IS NOT NULL AND complaint_id IS NOT NULL""")

oracle("value_counts", with_(COMPLAINTS)
       + "SELECT response, count(*) AS count FROM complaints WHERE response IS NOT NULL GROUP BY response")

oracle("value_shares", with_(COMPLAINTS)
       + "SELECT response, count(*) AS count, round(count(*) / (SELECT count(response) FROM complaints), 6) "
       "AS share FROM complaints WHERE response IS NOT NULL GROUP BY response")

oracle("length_stats", with_(CLEANED, WC)
       + "SELECT round(avg(clean_word_count), 6) AS mean, max(clean_word_count) AS max FROM wc")

oracle("length_describe", with_(CLEANED, WC) + """
SELECT count(clean_word_count) AS count, round(avg(clean_word_count), 6) AS mean,
  round(stddev_samp(clean_word_count), 6) AS std, CAST(min(clean_word_count) AS DOUBLE) AS min,
  round(quantile_cont(clean_word_count, 0.25), 6) AS p25, round(quantile_cont(clean_word_count, 0.5), 6) AS p50,
  round(quantile_cont(clean_word_count, 0.75), 6) AS p75, CAST(max(clean_word_count) AS DOUBLE) AS max
FROM wc""")

oracle("price_quantiles", "WITH ch AS (SELECT CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DOUBLE) AS v FROM lineitem) "
       + " UNION ALL ".join(f"SELECT {p}::DOUBLE AS probability, {Q.r6(f'quantile_cont(v, {p})')} AS value FROM ch"
                            for p in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)))


def _abbreviation_ctes(src: str, text: str) -> list[str]:
    def likelihood(p: str) -> str:
        q = f"greatest(least({p}, 1 - 1e-12::DOUBLE), 1e-12::DOUBLE)"
        return f"(k * ln({q}) + (n - k) * ln(1 - {q}))"
    return [
        f"bw AS (SELECT lower(unnest({Q.words(text)})) AS w FROM {src})",
        "bt AS (SELECT CASE WHEN w LIKE '%.' THEN w[:-2] ELSE w END AS token, w LIKE '%.' AS ends FROM bw)",
        "bc AS MATERIALIZED (SELECT token, count(*) FILTER (WHERE ends) AS with_period, count(*) FILTER (WHERE NOT ends) AS without, "
        "CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE ends) AS DOUBLE) AS k FROM bt "
        "WHERE regexp_matches(token, '\\p{L}') GROUP BY token)",
        "bp AS (SELECT CAST(sum(with_period) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS p FROM bc)",
        "bs AS (SELECT token, with_period, without, CAST(length(token) - length(replace(token, '.', '')) AS DOUBLE) AS inner_p, "
        f"-2 * ({likelihood('(SELECT p FROM bp)')} - {likelihood('0.99::DOUBLE')}) AS ratio FROM bc WHERE with_period > 0)",
        "abbr AS MATERIALIZED (SELECT * FROM (SELECT token, with_period, without, floor(ratio * exp(-(length(token) - inner_p)) * "
        "(inner_p + 1) * pow(length(token) - inner_p, -CAST(without AS DOUBLE)) * 1e6::DOUBLE + 0.5) / 1e6::DOUBLE AS score FROM bs) "
        "WHERE score >= 0.3)",
    ]


oracle("abbreviations", with_(COMPLAINTS_NR, *_abbreviation_ctes("complaints", "narrative"))
       + "SELECT token, with_period, without, score FROM abbr")
oracle("learned_sentences", with_(
    COMPLAINTS_NR, *_abbreviation_ctes("complaints", "narrative"),
    f"lw AS (SELECT complaint_id, {Q.words('narrative')} AS w FROM complaints)",
    "lt AS (SELECT complaint_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM lw)",
    "lb AS (SELECT t.complaint_id, t.w, t.i, regexp_matches(t.w, '[.!?]$') AND NOT (t.w LIKE '%.' AND a.token IS NOT NULL) AS ends "
    "FROM lt t LEFT JOIN abbr a ON a.token = lower(CASE WHEN t.w LIKE '%.' THEN t.w[:-2] ELSE t.w END))",
    "lg AS (SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY complaint_id ORDER BY i "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM lb)",
    "ls AS (SELECT complaint_id, g, string_agg(w, ' ' ORDER BY i) AS s FROM lg GROUP BY complaint_id, g)",
    "la AS (SELECT complaint_id, list(s ORDER BY g) AS sentences FROM ls GROUP BY complaint_id)")
    + "SELECT c.complaint_id, CASE WHEN c.narrative IS NULL THEN NULL ELSE coalesce(la.sentences, []::VARCHAR[]) END AS sentences "
    "FROM complaints c LEFT JOIN la ON la.complaint_id = c.complaint_id")

oracle("threshold_counts", with_(CLEANED, WC)
       + "SELECT count(*) FILTER (WHERE clean_word_count > 512) AS over, "
       "count(*) FILTER (WHERE clean_word_count < 512) AS under FROM wc")

oracle("length_bins", with_(
    CLEANED, WC,
    "labs AS (SELECT * FROM (VALUES (0, '<100'), (1, '100-300'), (2, '301-600'), (3, '601-1000'), "
    "(4, '>1000')) v(bin_order, bin))",
    "b AS (SELECT CASE WHEN word_count >= 1000 THEN 4 WHEN word_count >= 600 THEN 3 "
    "WHEN word_count >= 300 THEN 2 WHEN word_count >= 100 THEN 1 WHEN word_count >= 0 THEN 0 END "
    "AS bin_order FROM wc)") + """
SELECT l.bin_order, l.bin, CAST(count(b.bin_order) AS BIGINT) AS frequency
FROM labs l LEFT JOIN b ON b.bin_order = l.bin_order GROUP BY l.bin_order, l.bin""")

_W = "((hi - lo) / 30.0)"
oracle("length_histogram", with_(
    CLEANED, WC,
    "mm AS (SELECT CAST(min(clean_word_count) AS DOUBLE) AS lo, CAST(max(clean_word_count) AS DOUBLE) AS hi "
    "FROM wc)",
    "g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))",
    f"x AS (SELECT CAST(least(floor((CAST(clean_word_count AS DOUBLE) - lo) / {_W}), 29) AS INTEGER) AS bin "
    "FROM wc, mm)") + f"""
SELECT g.bin, round(lo + g.bin * {_W}, 6) AS lower, round(lo + (g.bin + 1) * {_W}, 6) AS upper,
  CAST(count(x.bin) AS BIGINT) AS count
FROM g CROSS JOIN mm LEFT JOIN x ON x.bin = g.bin GROUP BY g.bin, lo, hi""")

oracle("text_audit", with_(CLEANED)
       + "SELECT count(*) FILTER (WHERE regexp_matches(clean, '[^a-zA-Z\\t-\\r\\x1c-\\x20\\x{85}\\p{Z}]')) "
       "AS special_char_rows, count(*) FILTER (WHERE regexp_matches(clean, '[A-Z]')) AS uppercase_rows "
       "FROM cleaned")

oracle("wordcount_audit", with_(CLEANED, WC)
       + "SELECT count(*) FILTER (WHERE word_count IS NULL OR clean_word_count IS NULL "
       "OR word_count <> clean_word_count) AS mismatches, round(avg(word_count), 6) AS original_mean, "
       "round(avg(clean_word_count), 6) AS new_mean FROM wc")

_SW = Q.sql_list(STOP_WORDS)
oracle("stopword_counts", with_(CLEANED)
       + f"SELECT complaint_id, CAST(len(list_filter({Q.words('clean')}, lambda x: "
       f"list_contains({_SW}, lower(x)))) AS BIGINT) AS stopwords FROM cleaned")

oracle("sample_compare", with_(CLEANED, WC)
       + "SELECT complaint_id, narrative, clean, word_count, clean_word_count FROM wc "
       "ORDER BY complaint_id LIMIT 5")

oracle("examples_per_class", "WITH " + SCORED + f"""
, named AS (SELECT complaint_id, {SENT_NAME} AS sentiment FROM scored)
SELECT complaint_id, sentiment FROM named
QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY complaint_id) <= 3""")

oracle("distinct_values", with_(COMPLAINTS)
       + "SELECT response, min(complaint_id) AS first_key FROM complaints WHERE response IS NOT NULL "
       "GROUP BY response")

oracle("validate", with_(COMPLAINTS)
       + "SELECT complaint_id, narrative, product, issue, company, response FROM complaints "
       "WHERE response IS NOT NULL")

# --- filters ----------------------------------------------------------------

oracle("dropna_subset", with_(COMPLAINTS)
       + "SELECT complaint_id, response FROM complaints WHERE response IS NOT NULL")
oracle("dropna_any", with_(COMPLAINTS)
       + "SELECT complaint_id FROM complaints WHERE response IS NOT NULL AND narrative IS NOT NULL")
oracle("dropna_columns", with_(COMPLAINTS)
       + "SELECT complaint_id, narrative, product, company, issue FROM complaints")
oracle("exclude_label", with_(COMPLAINTS)
       + "SELECT complaint_id, response FROM complaints WHERE response IS DISTINCT FROM 'q0t1'")
oracle("length_cap", with_(CLEANED, WC)
       + "SELECT complaint_id, clean_word_count FROM wc WHERE clean_word_count <= 512")
oracle("rare_class_filter", with_(COMPLAINTS)
       + "SELECT complaint_id, response FROM complaints WHERE response IN "
       "(SELECT response FROM complaints WHERE response IS NOT NULL GROUP BY response HAVING count(*) > 10)")
oracle("not_in_values", with_(COMPLAINTS)
       + "SELECT complaint_id, response FROM complaints WHERE NOT coalesce(response IN ('q1t0', 'q0t0'), false)")
oracle("oversized_classes", with_(COMPLAINTS)
       + "SELECT complaint_id, response FROM complaints c WHERE NOT EXISTS (SELECT 1 FROM "
       "(SELECT response FROM complaints WHERE response IS NOT NULL GROUP BY response HAVING count(*) > 100) o "
       "WHERE o.response = c.response)")


# --- labels and weights -----------------------------------------------------

LABELLED = "labelled AS (SELECT * FROM complaints WHERE response IS NOT NULL)"
LABEL_TABLE = ("ltab AS (SELECT response, CAST(row_number() OVER (ORDER BY response) - 1 AS INTEGER) "
               "AS target FROM (SELECT DISTINCT response FROM labelled))")
oracle("label_encode", with_(COMPLAINTS, LABELLED, LABEL_TABLE)
       + "SELECT l.complaint_id, l.response, t.target FROM labelled l JOIN ltab t ON t.response = l.response")
oracle("label_decode", with_(COMPLAINTS, LABELLED, LABEL_TABLE)
       + "SELECT l.complaint_id, t.target, t.response AS decoded FROM labelled l "
       "JOIN ltab t ON t.response = l.response")
oracle("class_weights", with_(COMPLAINTS, LABELLED,
                              "cc AS (SELECT response, count(*) AS count FROM labelled GROUP BY response)")
       + "SELECT response, count, round((SELECT sum(count) FROM cc) / ((SELECT count(*) FROM cc) * count), 6) "
       "AS balanced_weight, round((SELECT sum(count) FROM cc) / count, 6) AS inverse_share_weight FROM cc")
oracle("sample_weights", with_(COMPLAINTS, LABELLED,
                               "cc AS (SELECT response, count(*) AS count FROM labelled GROUP BY response)")
       + "SELECT l.complaint_id, l.response, round(1.0 / c.count, 6) AS weight FROM labelled l "
       "JOIN cc c ON c.response = l.response")

# --- sampling, splits, folds ------------------------------------------------


def _h(seed, id_sql):
    return f"md5('{seed}' || ':' || CAST({id_sql} AS VARCHAR))"


def _u(hex_sql, start=1):
    return f"(CAST(('0x' || substr({hex_sql}, {start}, 13)) AS BIGINT) / 4503599627370496.0)"


EV_RANK = (f"evr AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type "
           f"ORDER BY {_h(42, 'event_id')}) AS rank, count(*) OVER (PARTITION BY event_type) AS class_n "
           f"FROM events)")

oracle("quota_sample", with_(EV_RANK)
       + "SELECT event_id, event_type FROM evr WHERE event_type IN ('click', 'view', 'error') AND rank <= 1000 "
       "UNION ALL SELECT event_id, event_type FROM events WHERE NOT coalesce(event_type IN "
       "('click', 'view', 'error'), false)")
oracle("cap_per_class",
       "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem QUALIFY row_number() OVER "
       f"(PARTITION BY l_returnflag ORDER BY {_h(42, chr(40) + 'l_orderkey || ' + repr('-') + ' || l_linenumber' + chr(41))}) <= 15000")
oracle("stratified_split", with_(EV_RANK)
       + "SELECT event_id, event_type, CASE WHEN rank <= floor(0.8 * class_n) THEN 'train' ELSE 'test' END "
       "AS split FROM evr")
oracle("three_way_split",
       f"SELECT event_id, CASE WHEN {_u(_h(42, 'event_id'))} < 0.6 THEN 'train' "
       f"WHEN {_u(_h(42, 'event_id'))} < {0.6 + 0.2!r} THEN 'validation' ELSE 'test' END AS split FROM events")
oracle("stratified_folds", with_(EV_RANK)
       + "SELECT event_id, event_type, CAST((rank - 1) % 5 AS INTEGER) AS fold FROM evr")
oracle("weighted_draws", with_(
    "items AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN "
    "CAST(floor(CAST(o_totalprice AS DOUBLE) * 1e6::DOUBLE + 0.5) AS BIGINT) ELSE 0 END AS units FROM orders)",
    f"rws AS (SELECT o_orderkey, units, {_h(42, 'o_orderkey')} AS h, (SELECT sum(units) FROM items) AS total FROM items WHERE units > 0)",
    "line AS (SELECT o_orderkey, total, sum(units) OVER (ORDER BY CASE WHEN units * 65536::HUGEINT >= total THEN 0 ELSE 1 END, h, "
    "o_orderkey ROWS UNBOUNDED PRECEDING) - units AS lo FROM rws)",
    "dr AS (SELECT event_id, least(CAST(floor(" + _u("md5('42' || ':draw:' || CAST(event_id AS VARCHAR))")
    + " * (SELECT CAST(max(total) AS DOUBLE) FROM line)) AS BIGINT), (SELECT max(total) FROM line) - 1) AS at FROM events)")
    + "SELECT d.event_id, l.o_orderkey FROM dr d ASOF JOIN line l ON d.at >= l.lo")
oracle("weighted_resample", with_(
    EV_RANK,
    "cls AS (SELECT event_type, max(class_n) AS cnt, row_number() OVER (ORDER BY event_type) - 1 AS cidx "
    "FROM evr GROUP BY event_type)",
    f"d0 AS (SELECT event_id AS draw_id, md5('42' || ':draw:' || CAST(event_id AS VARCHAR)) AS hd FROM events)",
    f"d1 AS (SELECT draw_id, hd, CAST(floor({_u('hd', 1)} * (SELECT count(*) FROM cls)) AS BIGINT) AS cidx FROM d0)",
    f"d2 AS (SELECT d1.draw_id, c.event_type, CAST(1 + floor({_u('d1.hd', 14)} * c.cnt) AS BIGINT) AS rank "
    "FROM d1 JOIN cls c ON c.cidx = d1.cidx)")
    + "SELECT d2.draw_id, e.event_id, e.event_type FROM d2 JOIN evr e ON e.event_type = d2.event_type "
    "AND e.rank = d2.rank")


# --- linear model over embeddings and evaluation metrics --------------------

EMB = [
    "er AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY "
    + _h(42, "vec_id") + ") AS rk, count(*) OVER (PARTITION BY label) AS cn FROM embeddings)",
    "tr AS (SELECT * FROM er WHERE rk <= floor(0.8 * cn))",
    "te AS (SELECT * FROM er WHERE rk > floor(0.8 * cn))",
    "cent AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM (SELECT label, unnest(embedding) AS x, "
    "generate_subscripts(embedding, 1) AS pos FROM tr) GROUP BY label, pos)",
    "tx AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM te)",
    "sc AS (SELECT tx.vec_id, tx.label AS y, c.label AS cls, sum(CAST(tx.x AS DOUBLE) * c.m) AS s "
    "FROM tx JOIN cent c ON c.pos = tx.pos GROUP BY tx.vec_id, tx.label, c.label)",
    "sm AS (SELECT *, max(s) OVER (PARTITION BY vec_id) AS mx FROM sc)",
    "se AS (SELECT *, exp(s - mx) AS e, sum(exp(s - mx)) OVER (PARTITION BY vec_id) AS z FROM sm)",
    "pv AS (SELECT vec_id, y, arg_max(cls, s) AS pred, max(s) AS smax, list(round(e / z * 100) / 100 ORDER BY cls) "
    "AS probs_2dp, max(mx) + ln(max(z)) AS lse, max(CASE WHEN cls = y THEN s END) AS sy FROM se GROUP BY vec_id, y)",
    "pp AS (SELECT pv.*, (SELECT e / z FROM se WHERE se.vec_id = pv.vec_id AND se.cls = pv.pred) AS prob FROM pv)",
]
oracle("linear_scores", with_(*EMB)
       + "SELECT vec_id, y AS label, pred, round(prob, 6) AS prob, probs_2dp FROM pp")
oracle("top_k_classes", with_(*EMB)
       + "SELECT vec_id, y AS label, list(CAST(cls AS INTEGER) ORDER BY s DESC, cls DESC)[1:3] AS top_3 "
       "FROM sc GROUP BY vec_id, y")
oracle("accuracy", with_(*EMB)
       + "SELECT round(avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM pv")
oracle("confusion_matrix", with_(
    *EMB, "cls AS (SELECT y AS c FROM pv UNION SELECT pred FROM pv)",
    "cnt AS (SELECT y, pred, count(*) AS n FROM pv GROUP BY y, pred)")
    + "SELECT a.c AS true_label, b.c AS pred_label, CAST(coalesce(cnt.n, 0) AS BIGINT) AS count "
    "FROM cls a CROSS JOIN cls b LEFT JOIN cnt ON cnt.y = a.c AND cnt.pred = b.c")
PER_CLASS = [
    "cls AS (SELECT y AS c FROM pv UNION SELECT pred FROM pv)",
    "t AS (SELECT c, (SELECT count(*) FROM pv WHERE y = c) AS support, (SELECT count(*) FROM pv WHERE pred = c) "
    "AS predicted, (SELECT count(*) FROM pv WHERE y = c AND pred = c) AS tp FROM cls)",
    "t2 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision, "
    "CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM t)",
    "pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
    "ELSE 0.0 END AS f1 FROM t2)",
]
oracle("classification_report", with_(*EMB, *PER_CLASS) + """
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc""")
oracle("weighted_f1", with_(*EMB, *PER_CLASS)
       + "SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM pc")
oracle("top_k_accuracy", with_(
    *EMB,
    "rk AS (SELECT a.vec_id, 1 + count(b.cls) AS r FROM sc a LEFT JOIN sc b ON b.vec_id = a.vec_id AND "
    "(b.s > a.s OR (b.s = a.s AND b.cls > a.cls)) WHERE a.cls = a.y GROUP BY a.vec_id)")
    + "SELECT round(avg(CASE WHEN r <= 3 THEN 1.0 ELSE 0.0 END), 6) AS top_3_accuracy, count(*) AS n FROM rk")
oracle("cross_entropy", with_(
    *EMB,
    "cc AS (SELECT y, count(*) AS n FROM pv GROUP BY y)",
    "w AS (SELECT y, round((SELECT sum(n) FROM cc) / ((SELECT count(*) FROM cc) * n), 6) AS w FROM cc)")
    + "SELECT round(avg(lse - sy), 6) AS mean_ce, round(sum(w.w * (lse - sy)) / sum(w.w), 6) AS weighted_ce "
    "FROM pv JOIN w ON w.y = pv.y")


# --- sentences, text assembly, names ----------------------------------------

SENTS = ("sents AS (SELECT complaint_id, unnest(ss) AS sent, generate_subscripts(ss, 1) - 1 AS spos "
         f"FROM (SELECT complaint_id, {Q.sentences('narrative')} AS ss FROM complaints))")
oracle("sentences", with_(COMPLAINTS_NR, SENTS)
       + "SELECT complaint_id, CAST(spos AS BIGINT) AS sentence_pos, sent AS sentence FROM sents")
oracle("dedupe_sentences", with_(
    COMPLAINTS_NR, SENTS,
    "firsts AS (SELECT complaint_id, sent, min(spos) AS spos FROM sents GROUP BY complaint_id, sent)",
    "dd AS (SELECT complaint_id, string_agg(sent, ' ' ORDER BY spos) AS deduped FROM firsts "
    "GROUP BY complaint_id)")
    + "SELECT c.complaint_id, coalesce(dd.deduped, '') AS deduped FROM complaints c "
    "LEFT JOIN dd ON dd.complaint_id = c.complaint_id")
oracle("build_text", with_(COMPLAINTS) + """
SELECT complaint_id,
  coalesce(response || ' ' || product || ' ' || issue || ' ' || company, '') AS text_empty,
  coalesce(narrative, '') || ' ' || coalesce(product, '') || ' ' || coalesce(issue, '') || ' '
    || coalesce(response, '') AS text_blank,
  concat_ws(' | ', CASE WHEN narrative <> '' THEN 'Complaint Narrative: ' || narrative END,
    CASE WHEN company <> '' THEN 'Company: ' || company END,
    CASE WHEN product <> '' THEN 'Product: ' || product END,
    CASE WHEN response <> '' THEN 'Response: ' || response END) AS text_skip,
  coalesce(response, '(none)') AS summary_or_default
FROM complaints""")
oracle("label_names", "WITH " + SCORED + f"""
SELECT complaint_id, sentiment, {SENT_NAME} AS sentiment_name FROM scored""")

# --- vocabulary and token encoding ------------------------------------------

VOCAB = (f"vc AS (SELECT tok AS token, count(*) AS count FROM (SELECT unnest({Q.words('clean')}) AS tok "
         "FROM cleaned) GROUP BY tok ORDER BY count DESC, token LIMIT 30000)",
         "vocabulary AS (SELECT token, count, CAST(row_number() OVER (ORDER BY count DESC, token) - 1 + 1000 "
         "AS INTEGER) AS token_id FROM vc)")
oracle("vocabulary", "WITH " + CLEANED_NR + ", " + ", ".join(VOCAB) + " SELECT * FROM vocabulary")
oracle("encode_tokens", "WITH " + CLEANED_NR + ", " + ", ".join(VOCAB) + """
, tw AS (SELECT complaint_id, """ + Q.words("clean") + """ AS w FROM cleaned)
, tk AS (SELECT complaint_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM tw)
, ids AS (SELECT tk.complaint_id, CAST(tk.pos // 126 AS INTEGER) AS window_index, tk.pos,
    CAST(coalesce(v.token_id, 100) AS INTEGER) AS tid FROM tk LEFT JOIN vocabulary v ON v.token = tk.token)
, g AS (SELECT complaint_id, window_index, list(tid ORDER BY pos) AS seq FROM ids GROUP BY complaint_id, window_index)
, g2 AS (SELECT * FROM g UNION ALL SELECT complaint_id, 0, []::INTEGER[] FROM tw WHERE len(w) = 0)
SELECT complaint_id, window_index,
  list_resize(list_concat([101], seq, [102]), 128, 0) AS input_ids,
  list_resize(list_resize([]::INTEGER[], len(seq) + 2, 1), 128, 0) AS attention_mask
FROM g2""")

# --- summaries and ROUGE ----------------------------------------------------

oracle("summary_budget", with_(COMPLAINTS_NR, "b AS (SELECT complaint_id, " + Q.word_count("narrative")
                               + " AS n_words FROM complaints)")
       + "SELECT complaint_id, n_words, CASE WHEN n_words >= 10 THEN least(n_words, 50) END AS min_words, "
       "CASE WHEN n_words >= 10 THEN least(n_words, 120) END AS max_words FROM b")

SUMM = [
    COMPLAINTS_NR, SENTS,
    f"sents2 AS (SELECT *, CAST(len({Q.words('sent')}) AS BIGINT) AS sw FROM sents)",
    f"toks AS (SELECT complaint_id, spos, unnest({Q.words(Q.clean('sent'))}) AS tok FROM sents)",
    "tf AS (SELECT complaint_id, tok, count(*) AS tf FROM toks GROUP BY complaint_id, tok)",
    "dlen AS (SELECT complaint_id, sum(tf) AS dlen FROM tf GROUP BY complaint_id)",
    "dfreq AS (SELECT tok, count(*) AS dfreq FROM tf GROUP BY tok)",
    "w AS (SELECT tf.complaint_id, tf.tok, CAST(round(tf.tf / dlen.dlen * ln((SELECT count(*) FROM complaints) "
    "/ dfreq.dfreq) * 1e9) AS BIGINT) AS wint FROM tf JOIN dfreq ON dfreq.tok = tf.tok "
    "JOIN dlen ON dlen.complaint_id = tf.complaint_id)",
    "ps AS (SELECT t.complaint_id, t.spos, sum(w.wint) AS ws, count(*) AS nt FROM toks t JOIN w "
    "ON w.complaint_id = t.complaint_id AND w.tok = t.tok GROUP BY t.complaint_id, t.spos)",
    "sc AS (SELECT s.*, coalesce(ps.ws / ps.nt, 0.0) AS score FROM sents2 s LEFT JOIN ps "
    "ON ps.complaint_id = s.complaint_id AND ps.spos = s.spos)",
    "rk AS (SELECT *, sum(sw) OVER (PARTITION BY complaint_id) AS n, row_number() OVER (PARTITION BY "
    "complaint_id ORDER BY score DESC, spos) AS rn, sum(sw) OVER (PARTITION BY complaint_id ORDER BY "
    "score DESC, spos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM sc)",
    "kept AS (SELECT * FROM rk WHERE n >= 10 AND (rn = 1 OR cum <= least(n, 120)))",
    "summ0 AS (SELECT complaint_id, string_agg(sent, ' ' ORDER BY spos) AS summary FROM kept "
    "GROUP BY complaint_id)",
    "summ AS (SELECT c.complaint_id, c.narrative, coalesce(s.summary, '') AS summary FROM complaints c "
    "LEFT JOIN summ0 s ON s.complaint_id = c.complaint_id)",
]
oracle("extractive_summary", with_(*SUMM) + "SELECT complaint_id, summary FROM summ")


def _rouge_ctes(n: int) -> list[str]:
    def grams(col):
        return (f"unnest(list_transform(range(1, len({col}) - {n} + 2), "
                f"lambda i: array_to_string({col}[i:i + {n - 1}], ' ')))")
    return [
        f"gg{n} AS (SELECT complaint_id, gram, count(*) AS cg FROM (SELECT complaint_id, {grams('g')} AS gram "
        f"FROM pr) GROUP BY complaint_id, gram)",
        f"rg{n} AS (SELECT complaint_id, gram, count(*) AS cr FROM (SELECT complaint_id, {grams('r')} AS gram "
        f"FROM pr) GROUP BY complaint_id, gram)",
        f"ov{n} AS (SELECT gg{n}.complaint_id, sum(least(cg, cr)) AS ov FROM gg{n} JOIN rg{n} ON "
        f"rg{n}.complaint_id = gg{n}.complaint_id AND rg{n}.gram = gg{n}.gram GROUP BY gg{n}.complaint_id)",
        f"sc{n} AS (SELECT pr.complaint_id, coalesce(ov{n}.ov, 0) / greatest(len(g) - {n} + 1, 1) AS p, "
        f"coalesce(ov{n}.ov, 0) / greatest(len(r) - {n} + 1, 1) AS r FROM pr LEFT JOIN ov{n} "
        f"ON ov{n}.complaint_id = pr.complaint_id)",
        f"m{n} AS (SELECT count(*) AS n_pairs, round(avg(p), 6) AS rouge{n}_p, round(avg(r), 6) AS rouge{n}_r, "
        f"round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END), 6) AS rouge{n}_f FROM sc{n})",
    ]


oracle("rouge_n", with_(
    *SUMM,
    f"pr AS (SELECT complaint_id, {Q.rouge_tokens('summary')} AS g, {Q.rouge_tokens('narrative')} AS r "
    "FROM summ WHERE summary <> '' AND narrative <> '')",
    *_rouge_ctes(1), *_rouge_ctes(2))
    + "SELECT m1.n_pairs, rouge1_p, rouge1_r, rouge1_f, rouge2_p, rouge2_r, rouge2_f FROM m1 JOIN m2 "
    "ON m1.n_pairs = m2.n_pairs")

oracle("embedding_match", with_(
    *EMB[:4],
    "cn AS (SELECT label, sqrt(sum(m * m)) AS nm FROM cent GROUP BY label)",
    "tx AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM te)",
    "vn AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS nv FROM tx GROUP BY vec_id)",
    "cs AS (SELECT tx.vec_id, c.label, sum(CAST(tx.x AS DOUBLE) * c.m) / (max(vn.nv) * max(cn.nm)) AS cos "
    "FROM tx JOIN cent c ON c.pos = tx.pos JOIN vn ON vn.vec_id = tx.vec_id JOIN cn ON cn.label = c.label "
    "GROUP BY tx.vec_id, c.label)",
    "pp AS (SELECT avg(mx) AS p FROM (SELECT vec_id, max(cos) AS mx FROM cs GROUP BY vec_id))",
    "rr AS (SELECT avg(mx) AS r FROM (SELECT label, max(cos) AS mx FROM cs GROUP BY label))")
    + "SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM pp, rr")


def _vector_ctes(src: str, text: str, window: int = 2) -> list[str]:
    """vdocs (token, docs) and vv (token, vec) of the words of ``src(text)``."""
    signed = ", ".join(f"sum(CASE WHEN (bits >> {j}) & 1 = 1 THEN -pmi ELSE pmi END)" for j in range(32))
    pairs = " UNION ALL ".join(f"SELECT unnest(list_zip(w[1:len(w) - {d}], w[{d + 1}:])) AS p FROM vw WHERE len(w) > {d}"
                               for d in range(1, window + 1))
    return [
        f"vw AS MATERIALIZED (SELECT {Q.words(text)} AS w FROM {src})",
        "vdocs AS MATERIALIZED (SELECT token, count(*) AS docs FROM (SELECT unnest(list_distinct(w)) AS token FROM vw) GROUP BY token)",
        f"va AS (SELECT p[1] AS a, p[2] AS b, count(*) AS n FROM ({pairs}) GROUP BY ALL)",
        "vp AS MATERIALIZED (SELECT word, other, sum(n) AS n FROM (SELECT a AS word, b AS other, n FROM va UNION ALL "
        "SELECT b, a, n FROM va) GROUP BY ALL)",
        "vs AS MATERIALIZED (SELECT word, sum(n) AS n FROM vp GROUP BY word)",
        "vi AS (SELECT p.word, CAST(floor(ln(p.n::DOUBLE * (SELECT CAST(sum(n) AS DOUBLE) FROM vs) / (a.n::DOUBLE * b.n::DOUBLE)) "
        "* 1e6::DOUBLE + 0.5) AS BIGINT) AS pmi, CAST('0x' || substr(md5(p.other), 1, 8) AS BIGINT) AS bits "
        "FROM vp p JOIN vs a ON a.word = p.word JOIN vs b ON b.word = p.other)",
        f"vl AS (SELECT word, [{signed}] AS sums FROM vi WHERE pmi > 0 GROUP BY word)",
        "vm AS (SELECT word, sums, list_max(list_transform(sums, lambda x: abs(x))) AS largest FROM vl)",
        "vq AS (SELECT word, list_transform(sums, lambda x: CASE WHEN largest > 0 THEN "
        "CAST(floor(CAST(x AS DOUBLE) * 1000::DOUBLE / CAST(largest AS DOUBLE) + 0.5) AS SMALLINT) ELSE 0::SMALLINT END) AS vec FROM vm)",
        "vv AS MATERIALIZED (SELECT d.token, d.docs, coalesce(q.vec, list_transform(range(32), lambda i: 0::SMALLINT)) AS vec "
        "FROM vdocs d LEFT JOIN vq q ON q.word = d.token)",
    ]


oracle("word_vectors", with_(CLEANED_NR, *_vector_ctes("cleaned", "clean")) + "SELECT token, docs, vec FROM vv")
oracle("pair_similarity", with_(
    *SUMM,
    f"pairs AS MATERIALIZED (SELECT complaint_id, {Q.clean('summary')} AS g, {Q.clean('narrative')} AS r FROM summ)",
    "texts AS (SELECT r FROM pairs WHERE r <> '')",
    *_vector_ctes("texts", "r"),
    "sides AS MATERIALIZED (SELECT complaint_id, side, token, count(*) AS tf FROM ("
    f"SELECT complaint_id, 0 AS side, unnest({Q.words('g')}) AS token FROM pairs WHERE g <> '' AND r <> '' UNION ALL "
    f"SELECT complaint_id, 1, unnest({Q.words('r')}) FROM pairs WHERE g <> '' AND r <> '') GROUP BY ALL)",
    "vn AS MATERIALIZED (SELECT token, docs, vec::DOUBLE[32] AS vec, list_dot_product(vec::DOUBLE[], vec::DOUBLE[]) AS n FROM vv)",
    "tv AS MATERIALIZED (SELECT s.*, v.vec, v.n, CAST(floor(ln((SELECT count(*) + 1 FROM texts)::DOUBLE / (v.docs + 1)::DOUBLE) "
    "* 1e6::DOUBLE + 0.5) AS BIGINT) AS idf FROM sides s JOIN vn v ON v.token = s.token)",
    "cs AS (SELECT a.complaint_id, a.token AS ga, b.token AS rb, CASE WHEN a.token = b.token THEN 1.0::DOUBLE "
    "WHEN a.n > 0 AND b.n > 0 THEN array_inner_product(a.vec, b.vec) / sqrt(a.n * b.n) ELSE 0.0::DOUBLE END AS c "
    "FROM tv a JOIN tv b ON b.complaint_id = a.complaint_id WHERE a.side = 0 AND b.side = 1)",
    "bg AS (SELECT complaint_id, 0 AS side, ga AS token, max(c) AS c FROM cs GROUP BY ALL UNION ALL "
    "SELECT complaint_id, 1, rb, max(c) FROM cs GROUP BY ALL)",
    "sm AS (SELECT t.complaint_id, t.side, sum(t.tf * t.idf) AS w, "
    "sum(t.tf * t.idf * CAST(floor(coalesce(b.c, 0) * 1e6::DOUBLE + 0.5) AS BIGINT)) AS s FROM tv t LEFT JOIN bg b "
    "ON b.complaint_id = t.complaint_id AND b.side = t.side AND b.token = t.token GROUP BY ALL)",
    "pr2 AS (SELECT p.complaint_id, coalesce(CASE WHEN a.w > 0 THEN CAST(a.s AS DOUBLE) / 1e6 / a.w END, 0) AS p, "
    "coalesce(CASE WHEN b.w > 0 THEN CAST(b.s AS DOUBLE) / 1e6 / b.w END, 0) AS r FROM pairs p "
    "LEFT JOIN sm a ON a.complaint_id = p.complaint_id AND a.side = 0 "
    "LEFT JOIN sm b ON b.complaint_id = p.complaint_id AND b.side = 1 WHERE p.g <> '' AND p.r <> '')")
    + f"SELECT complaint_id, {Q.r6('p')} AS p, {Q.r6('r')} AS r, "
    f"{Q.r6('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END')} AS f FROM pr2")


oracle("batch_model_scores", with_(*EMB) + "SELECT vec_id, y AS label, pred FROM pv")


for _name in ("csv_roundtrip", "csv_splits"):
    oracle(_name, with_(COMPLAINTS)
           + "SELECT complaint_id, narrative, product, company, issue, response FROM complaints")


oracle("stream_score", "WITH " + SCORED + f"""
SELECT complaint_id, product, sentiment, {SENT_NAME} AS sentiment_name FROM scored""")


def _chunk_ctes(max_words: int = 512) -> list[str]:
    n = f"CAST(len({Q.words('s')}) AS BIGINT)"
    step = ("lambda acc, x: CASE WHEN acc.cur_n + x.cur_n <= " + str(max_words) + " THEN "
            "{'done': acc.done, 'cur': CASE WHEN acc.cur = '' THEN x.cur ELSE acc.cur || ' ' || x.cur END, "
            "'cur_n': acc.cur_n + x.cur_n} "
            "ELSE {'done': list_append(acc.done, acc.cur), 'cur': x.cur, 'cur_n': x.cur_n} END")
    items = f"list_transform(ss, lambda s: {{'done': []::VARCHAR[], 'cur': s, 'cur_n': {n}}})"
    init = "{'done': []::VARCHAR[], 'cur': '', 'cur_n': CAST(0 AS BIGINT)}"
    return [
        COMPLAINTS_NR,
        f"ss AS (SELECT complaint_id, {Q.sentences('narrative')} AS ss FROM complaints)",
        f"acc AS (SELECT complaint_id, list_reduce({items}, {step}, {init}) AS acc FROM ss)",
        "cs AS (SELECT complaint_id, list_filter(list_append(acc.done, acc.cur), lambda c: c <> '') AS chunks "
        "FROM acc)",
        "ex AS (SELECT complaint_id, unnest(chunks) AS chunk, generate_subscripts(chunks, 1) - 1 AS chunk_index "
        "FROM cs)",
    ]


def _chunk_sql(max_words: int = 512) -> str:
    return with_(*_chunk_ctes(max_words)) + (
        f"SELECT complaint_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk, "
        f"{Q.word_count('chunk')} AS chunk_words FROM ex")


def _summary_ctes(p: str, src: str, key: str, text: str) -> list[str]:
    """The extractive-summary SQL over any (key, text) source, CTE names prefixed."""
    return [
        f"{p}sents AS (SELECT {key}, unnest(ss) AS sent, generate_subscripts(ss, 1) - 1 AS spos "
        f"FROM (SELECT {key}, {Q.sentences(text)} AS ss FROM {src}))",
        f"{p}sents2 AS (SELECT *, CAST(len({Q.words('sent')}) AS BIGINT) AS sw FROM {p}sents)",
        f"{p}toks AS (SELECT {key}, spos, unnest({Q.words(Q.clean('sent'))}) AS tok FROM {p}sents)",
        f"{p}tf AS (SELECT {key}, tok, count(*) AS tf FROM {p}toks GROUP BY {key}, tok)",
        f"{p}dlen AS (SELECT {key}, sum(tf) AS dlen FROM {p}tf GROUP BY {key})",
        f"{p}dfreq AS (SELECT tok, count(*) AS dfreq FROM {p}tf GROUP BY tok)",
        f"{p}w AS (SELECT a.{key}, a.tok, CAST(round(a.tf / d.dlen * ln((SELECT count(*) FROM {src}) "
        f"/ f.dfreq) * 1e9) AS BIGINT) AS wint FROM {p}tf a JOIN {p}dfreq f ON f.tok = a.tok "
        f"JOIN {p}dlen d ON d.{key} = a.{key})",
        f"{p}ps AS (SELECT t.{key}, t.spos, sum(w.wint) AS ws, count(*) AS nt FROM {p}toks t JOIN {p}w w "
        f"ON w.{key} = t.{key} AND w.tok = t.tok GROUP BY t.{key}, t.spos)",
        f"{p}sc AS (SELECT s.*, coalesce(ps.ws / ps.nt, 0.0) AS score FROM {p}sents2 s LEFT JOIN {p}ps ps "
        f"ON ps.{key} = s.{key} AND ps.spos = s.spos)",
        f"{p}rk AS (SELECT *, sum(sw) OVER (PARTITION BY {key}) AS n, row_number() OVER (PARTITION BY "
        f"{key} ORDER BY score DESC, spos) AS rn, sum(sw) OVER (PARTITION BY {key} ORDER BY "
        f"score DESC, spos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM {p}sc)",
        f"{p}kept AS (SELECT * FROM {p}rk WHERE n >= 10 AND (rn = 1 OR cum <= least(n, 120)))",
        f"{p}summ AS (SELECT {key}, string_agg(sent, ' ' ORDER BY spos) AS summary FROM {p}kept GROUP BY {key})",
    ]


oracle("chunked_summary", with_(
    *_chunk_ctes(512),
    "kd AS (SELECT CAST(complaint_id AS VARCHAR) || ':' || CAST(chunk_index AS VARCHAR) AS ck, complaint_id, "
    "chunk_index, chunk FROM ex)",
    *_summary_ctes("k_", "kd", "ck", "chunk"),
    "per AS (SELECT kd.complaint_id, kd.chunk_index, coalesce(s.summary, '') AS cs FROM kd "
    "LEFT JOIN k_summ s ON s.ck = kd.ck)",
    "agg AS (SELECT complaint_id, string_agg(cs, ' ' ORDER BY chunk_index) FILTER (WHERE cs <> '') AS summary "
    "FROM per GROUP BY complaint_id)")
    + "SELECT c.complaint_id, coalesce(a.summary, '') AS summary FROM complaints c "
    "LEFT JOIN agg a ON a.complaint_id = c.complaint_id")
oracle("chunk_sentences", _chunk_sql(512))


_COMBINED = ("concat_ws(' | ', CASE WHEN narrative <> '' THEN 'Complaint Narrative: ' || narrative END, "
             "CASE WHEN company <> '' THEN 'Company: ' || company END, "
             "CASE WHEN product <> '' THEN 'Product: ' || product END, "
             "CASE WHEN issue <> '' THEN 'Issue: ' || issue END)")
oracle("model_compare", "WITH " + CLEANED_NR + Q.lexicon_ctes() + ", " + ", ".join([
    *_summary_ctes("s_", "complaints", "complaint_id", "narrative"),
    "stacked AS (SELECT CAST(complaint_id AS VARCHAR) || '|combined' AS _key, complaint_id, 'combined' AS input, "
    + _COMBINED + " AS text FROM complaints UNION ALL "
    "SELECT CAST(c.complaint_id AS VARCHAR) || '|summary', c.complaint_id, 'summary', "
    "CASE WHEN coalesce(s.summary, '') <> '' THEN s.summary ELSE '(none)' END "
    "FROM complaints c LEFT JOIN s_summ s ON s.complaint_id = c.complaint_id)",
    f"sclean AS (SELECT _key, complaint_id, input, {Q.clean('text')} AS clean FROM stacked)",
    f"ptok AS (SELECT _key, unnest({Q.words('clean')}) AS tok FROM sclean)",
    "psum AS (SELECT t._key, sum(l.valence) AS s FROM ptok t JOIN lex l ON l.token = t.tok GROUP BY t._key)",
    "plain AS (SELECT c._key, CAST(coalesce(x.s, 0) AS DOUBLE) AS valence_sum FROM sclean c "
    "LEFT JOIN psum x ON x._key = c._key)",
    *_context_ctes("x_", "sclean", "_key"),
    "scored2 AS (SELECT _key, 'lexicon' AS model, valence_sum FROM plain UNION ALL "
    "SELECT _key, 'lexicon_context', valence_sum FROM x_sc)",
    "lab AS (SELECT b._key, b.model, " + Q.label(Q.compound("b.valence_sum")) + " AS sentiment FROM scored2 b)",
]) + f""" SELECT s.complaint_id, s.input, l.model, l.sentiment,
  CASE l.sentiment WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' WHEN 2 THEN 'Positive' END AS sentiment_name
FROM lab l JOIN stacked s ON s._key = l._key""")


# --- naive Bayes over exact words ---------------------------------------------

def _tokens(src: str, cols: str, pairs: bool, col: str = "clean") -> str:
    """Rows (``cols``, tok) of a table's texts; the words are computed before the lambda that pairs them."""
    w = f"SELECT {cols}, {Q.words(col)} AS w FROM {src}"
    toks = "unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))" if pairs else "unnest(w)"
    return f"(SELECT {cols}, {toks} AS tok FROM ({w}))"


def _bayes_ctes(p: str, train: str, rows: str, pairs: bool = False) -> list[str]:
    """Train on ``train`` (label, clean), score ``rows`` (_key, clean): {p}s (_key, label, score), {p}p predictions."""
    return [
        f"{p}c AS (SELECT label, tok, count(*) AS n FROM {_tokens(train, 'label', pairs)} GROUP BY label, tok)",
        f"{p}z AS (SELECT label, count(*) AS size FROM {train} GROUP BY label)",
        f"{p}l AS (SELECT z.label, CAST(round(ln(z.size / (SELECT sum(size) FROM {p}z)) * 1e9) AS BIGINT) AS prior, "
        f"greatest(coalesce((SELECT sum(n) FROM {p}c c WHERE c.label = z.label), 0) + "
        f"(SELECT count(DISTINCT tok) FROM {p}c), 1) AS total FROM {p}z z)",
        f"{p}l2 AS (SELECT *, CAST(round(ln(1 / total) * 1e9) AS BIGINT) AS unseen FROM {p}l)",
        f"{p}w AS (SELECT c.label, c.tok, CAST(round(ln((c.n + 1) / l.total) * 1e9) AS BIGINT) - l.unseen AS more "
        f"FROM {p}c c JOIN {p}l2 l ON l.label = c.label)",
        f"{p}t AS (SELECT _key, tok, count(*) AS m FROM {_tokens(rows, '_key', pairs)} GROUP BY _key, tok)",
        *_bayes_scores(p, rows, f"{p}w w ON w.tok = t.tok", f"{p}l2 l ON true"),
    ]


def _bayes_scores(p: str, rows: str, weights: str, classes: str) -> list[str]:
    """Scores and predictions of rows with tokens {p}t (_key, tok, m)."""
    return [
        f"{p}n AS (SELECT _key, sum(m) AS nt FROM {p}t GROUP BY _key)",
        f"{p}d AS (SELECT t._key, w.label, sum(t.m * w.more) AS more FROM {p}t t JOIN {weights} GROUP BY ALL)",
        f"{p}s AS (SELECT r._key, l.label, l.prior + coalesce(n.nt, 0) * l.unseen + coalesce(d.more, 0) AS score "
        f"FROM {rows} r JOIN {classes} LEFT JOIN {p}n n ON n._key = r._key "
        f"LEFT JOIN {p}d d ON d._key = r._key AND d.label = l.label)",
        f"{p}m AS (SELECT *, max(score) OVER (PARTITION BY _key) AS top, row_number() OVER (PARTITION BY _key "
        f"ORDER BY score DESC, label) AS nth FROM {p}s)",
        f"{p}p AS (SELECT _key, max(label) FILTER (WHERE nth = 1) AS predicted, "
        f"round(1 / sum(exp((score - top) / 1e9)), 6) AS probability FROM {p}m GROUP BY _key)",
    ]


def _train(label: str) -> list[str]:
    """train (label, clean) and test (_key, label, clean): 80% of each class in hash order, and the rest."""
    return [
        f"labs AS (SELECT complaint_id, {label} AS label, clean, row_number() OVER (PARTITION BY {label} ORDER BY "
        f"{_h(42, 'complaint_id')}) AS rk, count(*) OVER (PARTITION BY {label}) AS cn FROM cleaned "
        f"WHERE {label} IS NOT NULL)",
        "train AS (SELECT * FROM labs WHERE rk <= floor(0.8 * cn))",
        "test AS (SELECT complaint_id AS _key, label, clean FROM labs WHERE rk > floor(0.8 * cn))",
    ]


_ALL = "everything AS (SELECT complaint_id AS _key, clean FROM cleaned)"
_TEXT_SCORES = (with_(CLEANED, *_train("response"), _ALL, *_bayes_ctes("b_", "train", "everything"))
                + "SELECT _key AS complaint_id, predicted AS predicted_response, probability FROM b_p")
oracle("batch_text_scores", _TEXT_SCORES)
oracle("stream_classify", _TEXT_SCORES)
oracle("trained_model_compare", with_(
    CLEANED, *_train("response"), *_summary_ctes("s_", "complaints", "complaint_id", "narrative"),
    "stacked AS (SELECT CAST(complaint_id AS VARCHAR) || '|combined' AS _key, complaint_id, 'combined' AS input, "
    + _COMBINED + " AS text FROM complaints UNION ALL "
    "SELECT CAST(c.complaint_id AS VARCHAR) || '|summary', c.complaint_id, 'summary', coalesce(s.summary, '') "
    "FROM complaints c LEFT JOIN s_summ s ON s.complaint_id = c.complaint_id)",
    f"sclean AS (SELECT _key, {Q.clean('text')} AS clean FROM stacked)",
    *_bayes_ctes("w_", "train", "sclean"), *_bayes_ctes("x_", "train", "sclean", True),
    "twin AS (SELECT _key, 'words' AS model, predicted, probability FROM w_p UNION ALL "
    "SELECT _key, 'pairs', predicted, probability FROM x_p)")
    + "SELECT s.complaint_id, s.input, b.model, b.predicted AS predicted_response, b.probability "
    "FROM twin b JOIN stacked s ON s._key = b._key")
# a separate fit on the other folds' rows for every fold
oracle("cross_validate_words", "WITH " + SCORED + ", " + ", ".join([
    f"labelled AS (SELECT s.complaint_id AS _key, {SENT_NAME} AS label, c.clean "
    "FROM scored s JOIN cleaned c ON c.complaint_id = s.complaint_id)",
    "folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY "
    + _h(42, "_key") + ") - 1) % 5 AS INTEGER) AS fold FROM labelled)",
    "fs AS (SELECT DISTINCT fold AS f FROM folds)",
    f"x_o AS (SELECT fold, label, tok, count(*) AS n FROM {_tokens('folds', 'fold, label', False)} GROUP BY ALL)",
    "x_c AS (SELECT fs.f, o.label, o.tok, sum(o.n) AS n FROM x_o o JOIN fs ON o.fold <> fs.f GROUP BY ALL)",
    "x_z AS (SELECT fs.f, r.label, count(*) AS size FROM folds r JOIN fs ON r.fold <> fs.f GROUP BY ALL)",
    "x_v AS (SELECT f, count(DISTINCT tok) AS v FROM x_c GROUP BY f)",
    "x_k AS (SELECT f, label, sum(n) AS n FROM x_c GROUP BY f, label)",
    "x_l AS (SELECT z.f, z.label, CAST(round(ln(z.size / sum(z.size) OVER (PARTITION BY z.f)) * 1e9) AS BIGINT) AS prior, "
    "greatest(coalesce(k.n, 0) + coalesce(v.v, 0), 1) AS total FROM x_z z LEFT JOIN x_k k ON k.f = z.f AND k.label = z.label "
    "LEFT JOIN x_v v ON v.f = z.f)",
    "x_l2 AS (SELECT *, CAST(round(ln(1 / total) * 1e9) AS BIGINT) AS unseen FROM x_l)",
    "x_w AS (SELECT c.f, c.label, c.tok, CAST(round(ln((c.n + 1) / l.total) * 1e9) AS BIGINT) - l.unseen AS more "
    "FROM x_c c JOIN x_l2 l ON l.label = c.label AND l.f = c.f)",
    f"x_t AS (SELECT _key, fold, tok, count(*) AS m FROM {_tokens('folds', '_key, fold', False)} GROUP BY ALL)",
    *_bayes_scores("x_", "folds", "x_w w ON w.tok = t.tok AND w.f = t.fold", "x_l2 l ON l.f = r.fold"),
]) + """ SELECT f._key AS complaint_id, f.fold, f.label AS sentiment, p.predicted AS predicted_sentiment, p.probability
FROM folds f JOIN x_p p ON p._key = f._key""")
def _softmax_ctes(epochs: int = 6, patience: int = 2, rate: float = 40.0) -> list[str]:
    """All epochs unrolled: ``hist`` (the epochs up to the stop), ``best`` and ``zall`` (scores by epoch)."""
    out = [
        CLEANED,
        "parts AS MATERIALIZED (SELECT complaint_id AS _key, response AS label, clean, CASE WHEN "
        f"{_u(_h(42, 'complaint_id'))} < 0.6 THEN 'train' WHEN {_u(_h(42, 'complaint_id'))} < {0.6 + 0.2!r} "
        "THEN 'validation' ELSE 'test' END AS part FROM cleaned WHERE response IS NOT NULL)",
        "kinds AS MATERIALIZED (SELECT label, count(*) AS c FROM parts WHERE part = 'train' GROUP BY label)",
        "wt AS MATERIALIZED (SELECT label, c, CAST(floor(1000::DOUBLE * (SELECT sum(c) FROM kinds) / "
        "((SELECT count(*) FROM kinds) * c) + 0.5) AS BIGINT) AS weight FROM kinds)",
        "mass AS MATERIALIZED (SELECT CAST(sum(weight * c) AS DOUBLE) AS mass FROM wt)",
        f"docs AS MATERIALIZED (SELECT p._key, p.part, p.label, wt.weight, list_distinct({Q.words('p.clean')}) AS w "
        "FROM parts p LEFT JOIN wt ON wt.label = p.label WHERE p.part = 'test' OR wt.label IS NOT NULL)",
        "cells AS MATERIALIZED (SELECT _key, part, unnest(w) AS tok, "
        "CAST(floor(1000 / sqrt(greatest(len(w), 1)::DOUBLE) + 0.5) AS BIGINT) AS x FROM docs "
        "UNION ALL SELECT _key, part, '', 1000 FROM docs)",
        "z0 AS MATERIALIZED (SELECT d._key, c.label AS cl, 0::DOUBLE AS z FROM docs d CROSS JOIN kinds c)",
        "w0 AS MATERIALIZED (SELECT '' AS tok, '' AS cl, 0::BIGINT AS w WHERE false)",
    ]
    for e in range(epochs + 1):
        if e:
            out += [
                f"g{e} AS (SELECT c.tok, j.cl, CAST(sum(c.x * j.weight::HUGEINT * j.r) AS DOUBLE) AS g FROM cells c "
                f"JOIN j{e - 1} j ON j._key = c._key WHERE c.part = 'train' GROUP BY c.tok, j.cl)",
                f"w{e} AS MATERIALIZED (SELECT g.tok, g.cl, coalesce(o.w, 0) - CAST(floor(g.g * {rate}::DOUBLE / "
                f"((SELECT mass FROM mass) * 1000) + 0.5) AS BIGINT) AS w FROM g{e} g LEFT JOIN w{e - 1} o "
                "ON o.tok = g.tok AND o.cl = g.cl)",
                f"s{e} AS (SELECT c._key, w.cl, sum(c.x::HUGEINT * w.w) AS s FROM cells c JOIN w{e} w ON w.tok = c.tok GROUP BY ALL)",
                f"z{e} AS MATERIALIZED (SELECT d._key, c.label AS cl, CAST(coalesce(s.s, 0) AS DOUBLE) / 1e12 AS z "
                f"FROM docs d CROSS JOIN kinds c LEFT JOIN s{e} s ON s._key = d._key AND s.cl = c.label)",
            ]
        out += [
            f"m{e} AS (SELECT *, z - max(z) OVER (PARTITION BY _key) AS d FROM z{e})",
            f"tt{e} AS (SELECT *, exp(d) AS e, sum(exp(d)) OVER (PARTITION BY _key) AS total FROM m{e})",
            f"j{e} AS MATERIALIZED (SELECT t._key, t.cl, d.part, d.weight, CAST(floor((t.e / t.total - CASE WHEN t.cl = d.label "
            "THEN 1 ELSE 0 END) * 1e9::DOUBLE + 0.5) AS BIGINT) AS r, CASE WHEN t.cl = d.label THEN "
            f"CAST(floor((ln(t.total) - t.d) * 1e9::DOUBLE + 0.5) AS BIGINT) END AS loss FROM tt{e} t JOIN docs d ON d._key = t._key)",
            f"l{e} AS (SELECT CAST(sum(loss::HUGEINT * weight) FILTER (WHERE part = 'train') AS DOUBLE) / "
            "(sum(weight) FILTER (WHERE part = 'train' AND loss IS NOT NULL) * 1e9::DOUBLE) AS tl, "
            "CAST(sum(loss) FILTER (WHERE part = 'validation') AS DOUBLE) / "
            f"(count(loss) FILTER (WHERE part = 'validation') * 1e9::DOUBLE) AS vl FROM j{e})",
        ]
    rows = " UNION ALL ".join(f"SELECT {e} AS epoch, (SELECT tl FROM l{e - 1}) AS tl, (SELECT vl FROM l{e}) AS vl"
                              for e in range(1, epochs + 1))
    return out + [
        f"allh AS MATERIALIZED ({rows})",
        "improved AS (SELECT *, vl < coalesce(min(vl) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
        "'inf'::DOUBLE) AS up FROM allh)",
        "lasts AS (SELECT *, max(CASE WHEN up THEN epoch END) OVER (ORDER BY epoch) AS last FROM improved)",
        f"stop AS (SELECT coalesce(min(epoch) FILTER (WHERE epoch - last >= {patience}), max(epoch)) AS stop FROM lasts)",
        "best AS (SELECT last AS best FROM lasts WHERE epoch = (SELECT stop FROM stop))",
        "hist AS (SELECT * FROM lasts WHERE epoch <= (SELECT stop FROM stop))",
        "zall AS (" + " UNION ALL ".join(f"SELECT {e} AS epoch, * FROM z{e}" for e in range(1, epochs + 1)) + ")",
    ]


oracle("early_stopping", with_(*_softmax_ctes()) + f"""
SELECT CAST(epoch AS INTEGER) AS epoch, {Q.r6('tl')} AS train_loss, {Q.r6('vl')} AS validation_loss,
  epoch = (SELECT best FROM best) AS best FROM hist""")
_ISSUES = [CLEANED, *_train("issue"), *_bayes_ctes("b_", "train", "test"),
           "pv AS (SELECT t._key, t.label AS y, p.predicted AS pred FROM test t JOIN b_p p ON p._key = t._key)"]
oracle("issue_confusion", with_(
    *_ISSUES, "cls AS (SELECT y AS c FROM pv UNION SELECT pred FROM pv)",
    "cnt AS (SELECT y, pred, count(*) AS n FROM pv GROUP BY y, pred)")
    + "SELECT a.c AS true_label, b.c AS pred_label, CAST(coalesce(cnt.n, 0) AS BIGINT) AS count "
    "FROM cls a CROSS JOIN cls b LEFT JOIN cnt ON cnt.y = a.c AND cnt.pred = b.c")
_REPORT = """
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc"""
oracle("issue_classifier", with_(
    *_ISSUES, *PER_CLASS,
    "rk AS (SELECT t._key, (SELECT 1 + count(*) FROM b_s o WHERE o._key = t._key AND (o.score > a.score OR "
    "(o.score = a.score AND o.label > a.label))) AS r FROM test t LEFT JOIN b_s a ON a._key = t._key "
    "AND a.label = t.label)") + _REPORT + """
UNION ALL SELECT 'top 3 accuracy', NULL, NULL, round(avg(CASE WHEN r <= 3 THEN 1.0 ELSE 0.0 END), 6),
  count(*) FROM rk""")
oracle("early_stopping_report", with_(
    *_softmax_ctes(),
    "nth AS (SELECT z._key, z.cl, row_number() OVER (PARTITION BY z._key ORDER BY z.z DESC, z.cl) AS nth FROM zall z "
    "WHERE z.epoch = (SELECT best FROM best))",
    "pv AS (SELECT d._key, d.label AS y, n.cl AS pred FROM docs d JOIN nth n ON n._key = d._key AND n.nth = 1 "
    "WHERE d.part = 'test')", *PER_CLASS) + _REPORT)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
