"""DuckDB SQL spellings of the text functions, for the oracle queries.

RE2 has no look-around, so the two word-bounded removals of the cleaning
rule are written as "whole token between spaces" replacements applied twice
(a single pass misses the second of two adjacent matches because they share
the space between them). After the punctuation step the text holds only
word characters and spaces, so this equals the Unicode ``\\b`` rule.
"""

from __future__ import annotations

WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
SENT_MARK = "chr(1)"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def _twice(x: str, pattern: str) -> str:
    once = f"regexp_replace({x}, '{pattern}', '\\1\\2', 'g')"
    return f"regexp_replace({once}, '{pattern}', '\\1\\2', 'g')"


def clean(x: str) -> str:
    t = f"lower({collapse(x)})"
    t = f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')"
    t = _twice(t, r"(^| )\p{Nd}{1,5} +usc( |$)")
    t = _twice(t, r"(^| )x{2,}( |$)")
    return t


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"CAST(len({words(x)}) AS BIGINT)"


def sentences(x: str) -> str:
    t = f"regexp_replace({collapse(x)}, '([.!?]) ', '\\1' || {SENT_MARK}, 'g')"
    return (f"list_filter(list_transform(string_split({t}, {SENT_MARK}), lambda s: trim(s)),"
            f" lambda s: s <> '')")


def rouge_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: w <> '')"


def sql_list(values) -> str:
    def q(v):
        return "'" + str(v).replace("'", "''") + "'"
    return "[" + ", ".join(q(v) for v in values) + "]"


def complaints_cte(with_response: bool = True) -> str:
    resp = (", CASE WHEN l.doc_id IS NULL THEN NULL ELSE 'q' || CAST(l.quality AS VARCHAR) || 't' "
            "|| CAST(l.toxic AS VARCHAR) END AS response" if with_response else "")
    join = " LEFT JOIN labels l ON l.doc_id = d.doc_id" if with_response else ""
    return (f"complaints AS (SELECT d.doc_id AS complaint_id, d.text AS narrative, d.lang AS product, "
            f"d.source AS company, 'issue_' || CAST(d.doc_id % 7 AS VARCHAR) AS issue{resp} "
            f"FROM documents d{join})")


def cleaned_cte(with_response: bool = True) -> str:
    return (complaints_cte(with_response) +
            f", cleaned AS (SELECT *, {clean('narrative')} AS clean FROM complaints "
            f"WHERE {clean('narrative')} <> '')")


def lexicon_ctes() -> str:
    """vocab(token) and lex(token, valence) built from cleaned; needs cleaned_cte first."""
    return (f", vocab AS (SELECT DISTINCT unnest({words('clean')}) AS token FROM cleaned)"
            ", lex AS (SELECT token, CASE WHEN substr(md5(token), 1, 1) IN ('0', '1') THEN 1.5 "
            "WHEN substr(md5(token), 1, 1) IN ('2', '3') THEN -1.5 END AS valence FROM vocab "
            "WHERE substr(md5(token), 1, 1) IN ('0', '1', '2', '3'))")


def compound(s: str) -> str:
    return f"({s}) / sqrt(({s}) * ({s}) + 15.0)"


def label(c: str) -> str:
    return f"CASE WHEN {c} >= 0.05 THEN 2 WHEN {c} <= -0.05 THEN 0 ELSE 1 END"


def r6(x: str) -> str:
    """Same rounding as ``narrata.functions.numeric.round6``."""
    return f"(round(CAST({x} AS DOUBLE) * 1e6) / 1e6)"
