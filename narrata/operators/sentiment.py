"""Lexicon sentiment (M1-M3): valence sum, compound score, 3-way label.

The lexicon is a table ``(token, valence)``. Up to ``MAX_LEXICON_BYTES`` it
becomes one value of the plan, a hash table of small buckets, and every text
is scored within its row: no token leaves the row, nothing is shuffled or
grouped, and rows that share an id stay rows. With a larger lexicon the
numbered rows are written with their words: common words meet it by broadcast
where the rows lie, and only rare words are exchanged (``common_words``). The
words of a row sit in one partition, so the partial aggregate collapses them
to one row. Both ways give the same sums, as these are of whole numbers.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.functions.lookup import RowTable, row_table
from narrata.functions.numeric import round6
from narrata.operators import common_words as CW
from narrata.operators import word_bayes as WB
from narrata.sources import io as IO

#: UTF-8 bytes and numbers of a lexicon that travels with the plan, of which the driver holds several copies; a larger one is joined.
MAX_LEXICON_BYTES = 256 << 10
#: Texts whose words a task numbers at once.
ROWS_AT_ONCE = 256

# ---------------------------------------------------------------------------
# Fixed values of the rule-based scorer (Hutto & Gilbert 2014).
COMPOUND_ALPHA = 15.0          # compound = s / sqrt(s^2 + alpha)
POSITIVE_AT = 0.05             # compound >= 0.05  -> 2 (positive)
NEGATIVE_AT = -0.05            # compound <= -0.05 -> 0 (negative), else 1
NEGATION_SCALAR = -0.74        # negator within the 3 previous words
BOOSTER_INCREMENT = 0.293      # booster within the 3 previous words
BOOSTER_DAMPING = (1.0, 0.95, 0.9)   # by distance 1, 2, 3
BEFORE_CONTRAST = 0.5          # words before the first contrast word ("but")
AFTER_CONTRAST = 1.5           # words after it
SENTIMENT_NAMES = {0: "Negative", 1: "Neutral", 2: "Positive"}
# ---------------------------------------------------------------------------


def compound(sum_col) -> Column:
    s = F.col(sum_col) if isinstance(sum_col, str) else sum_col
    return s / F.sqrt(s * s + F.lit(COMPOUND_ALPHA))


def sentiment_label(compound_col) -> Column:
    c = F.col(compound_col) if isinstance(compound_col, str) else compound_col
    return (F.when(c >= POSITIVE_AT, F.lit(2))
            .when(c <= NEGATIVE_AT, F.lit(0))
            .otherwise(F.lit(1)))


def _roles(lexicon: DataFrame, negators: DataFrame | None = None, boosters: DataFrame | None = None) -> DataFrame:
    """(token, val, neg, bst), a row for each token; repeated lexicon rows add up, null tokens are left out."""
    units = F.round(F.col("valence") * F.lit(1e9)).cast("long")
    parts = [lexicon.select("token", units.alias("val"), F.lit(False).alias("neg"), F.lit(False).alias("bst"))]
    none = F.lit(None).cast("long")
    if negators is not None:
        parts.append(negators.select("token", none, F.lit(True), F.lit(False)))
    if boosters is not None:
        parts.append(boosters.select("token", none, F.lit(False), F.lit(True)))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every.filter(F.col("token").isNotNull()).groupBy("token").agg(
        F.sum("val").alias("val"), F.bool_or("neg").alias("neg"), F.bool_or("bst").alias("bst"))


_ROLES = ["val", "neg", "bst"]


def row_lexicon(roles: DataFrame) -> RowTable | None:
    """The roles as a value of the plan if they are small enough, else None."""
    return row_table(roles, _ROLES, MAX_LEXICON_BYTES)


class TextWords:
    """The words of texts, cut and counted once for all scorers with large lexicons that read them; nothing is done before it is asked for.

    ``rows`` (keep, row, words) are written and numbered, their words as one
    string with spaces; ``common`` are the words that go to every task, and
    ``hot`` those whose keys are salted.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, keep=()):
        self._df, self._id_col, self._text_col, self._keep = df, id_col, text_col, keep
        self._run = f"lexicon-{uuid.uuid4().hex}"

    @functools.cached_property
    def rows(self) -> DataFrame:
        words = F.coalesce(T.spaced(self._text_col), F.lit(""))
        return IO.materialize(self._df.select(
            F.struct(self._id_col, *self._keep).alias("keep"), F.monotonically_increasing_id().alias("row"), words.alias("words")),
            self._df.sparkSession, f"{self._run}/rows")

    @functools.cached_property
    def counts(self) -> DataFrame:
        return IO.materialize(T.exploded(self.rows, T.spaced_words("words")).groupBy("token").agg(F.count("*").alias("n")),
                              self._df.sparkSession, f"{self._run}/counts")

    @functools.cached_property
    def common(self) -> DataFrame:
        return CW.common(self.counts, f"{self._run}/common")

    @functools.cached_property
    def hot(self) -> list[str]:
        return WB.hot_tokens(self.counts)

    def often(self, roles: DataFrame) -> DataFrame:
        """The common words with their roles."""
        met = self.common.join(roles, "token", "left").select("token", *_ROLES)
        return IO.materialize(met, self._df.sparkSession, f"{self._run}/roles")


def _finish(scored: DataFrame) -> DataFrame:
    return (scored.withColumn("compound", compound("valence_sum"))
            .withColumn("sentiment", sentiment_label("compound")))


def lexicon_sentiment(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame | RowTable,
                      keep=(), words: TextWords | None = None) -> DataFrame:
    """Each row's valence sum, compound score and label.

    Returns ``id_col, *keep, valence_sum, compound, sentiment``; a text with
    no lexicon word (or a null one) scores 0 and is neutral; repeated rows
    stay rows. Valences are summed as whole numbers of 1e-9, so a sum doesn't
    depend on its order. With a lexicon too large for the plan, the texts'
    words are written once, numbered, and only numbers go with rare words;
    ``words``: those of these texts, where another scorer reads them too.
    """
    held = lexicon
    if isinstance(lexicon, DataFrame):
        roles = IO.materialize(_roles(lexicon), lexicon.sparkSession, "lexicon")
        held = row_lexicon(roles)
    if held is not None:
        total = F.aggregate(T.words(text_col), F.lit(0).cast("long"),
                            lambda a, w: a + F.coalesce(held.of(w)["val"], F.lit(0).cast("long")))
        value = F.coalesce(total, F.lit(0)) / F.lit(1e9)
        return _finish(df.select(id_col, *keep, value.cast("double").alias("valence_sum")))
    own = words or TextWords(df, id_col, text_col, keep)
    rows, often = own.rows, own.often(roles)
    tokens = T.exploded(rows, T.spaced_words("words"), "row")
    # most words have no valence: they leave at the broadcast, before anything is grouped
    met = CW.all_met(tokens, often.select("token", "val"), roles.select("token", "val"), own.hot).filter("val IS NOT NULL")
    sums = met.groupBy("row").agg(F.sum("val").alias("val"))
    value = (F.coalesce("val", F.lit(0)) / F.lit(1e9)).cast("double")
    return _finish(rows.select("row", "keep").join(sums, "row", "left").select("keep.*", value.alias("valence_sum")))


def lexicon_sentiment_context(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame,
                              negators: DataFrame, boosters: DataFrame, contrast_word,
                              keep=(), words: TextWords | None = None) -> DataFrame:
    """Valence with context rules: negation, boosters, contrast word.

    For a lexicon word at position p, for d = 1, 2, 3 in turn: if the word at
    p-d is not in the lexicon and is a booster, add ``0.293 * damping[d]``
    with the sign of the running valence; if it is a negator, multiply by
    -0.74. Booster words themselves begin at 0. Words before the first
    contrast word are halved, words after it count 1.5x.

    A word's neighbours are in its row, so all rules are applied there. With
    role tables that fit the plan nothing is exchanged; otherwise a row gets
    the roles of its rare words by its number, and those of the common words
    go to every task. Word contributions are summed as whole numbers of 1e-9.
    ``contrast_word`` is a string or a one-row DataFrame with column
    ``token``; repeated rows stay rows, a null text scores 0. ``words``: as in
    :func:`lexicon_sentiment`.
    """
    if isinstance(contrast_word, DataFrame):
        row = contrast_word.select("token").first()
        contrast_word = row.token if row else None
    contrast = F.lit(contrast_word).cast("string")
    roles = IO.materialize(_roles(lexicon, negators, boosters), lexicon.sparkSession, "word-roles")
    held = row_lexicon(roles)
    if held is None:
        return _joined_context(words or TextWords(df, id_col, text_col, keep), roles, contrast_word)
    rows = df.select(F.struct(id_col, *keep).alias("keep"), F.coalesce(T.words(text_col), F.array().cast("array<string>"))
                     .alias("words"))
    rows = rows.select("keep", F.transform("words", held.of).alias("roles"),
                       (F.array_position("words", contrast) - 1).alias("at"))

    damped = F.array(*[F.lit(BOOSTER_INCREMENT * x) for x in BOOSTER_DAMPING])

    def worth(role: Column, i: Column) -> Column:
        start = F.when(role["bst"], F.lit(0.0)).otherwise(role["val"] / F.lit(1e9))
        value = F.aggregate(F.array(*[F.lit(d) for d in (1, 2, 3)]), start, lambda v, d: _ruled(
            v, F.get("roles", i - d), F.element_at(damped, d)))
        value = (F.when(F.coalesce(F.col("at"), F.lit(-1)) < 0, value).when(i < F.col("at"), value * F.lit(BEFORE_CONTRAST))
                 .when(i > F.col("at"), value * F.lit(AFTER_CONTRAST)).otherwise(value))
        return F.coalesce(F.round(value * F.lit(1e9)).cast("long"), F.lit(0).cast("long"))
    total = F.aggregate(F.transform("roles", worth), F.lit(0).cast("long"), lambda a, x: a + x)
    return _finish(rows.select("keep.*", (total / F.lit(1e9)).cast("double").alias("valence_sum")))


def _ruled(v: Column, before: Column, increment: Column) -> Column:
    """The running valence after the rules for one earlier word."""
    free = before["val"].isNull()
    is_bst, is_neg = (F.coalesce(before[x] & free, F.lit(False)) for x in ("bst", "neg"))
    v = v + F.when(is_bst, F.when(v < 0, -increment).otherwise(increment)).otherwise(F.lit(0.0))
    return F.when(is_neg, v * F.lit(NEGATION_SCALAR)).otherwise(v)


def _units(texts: pa.Array, common: dict, own: dict, contrast: str | None) -> np.ndarray:
    """Each text's sum of word contributions in 1e-9, given words' roles (valence in 1e-9, negator, booster): all words at once.

    The rules act word by word in the order of the published ones, so a value
    is the same as one worked out alone.
    """
    cut = pc.split_pattern(texts, " ")
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy(zero_copy_only=False))
    coded = cut.flatten().dictionary_encode()
    code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    roles = [common.get(w) or own.get(w) or (None, False, False) for w in distinct]
    has = np.array([r[0] is not None for r in roles], bool)[code]
    val = np.array([r[0] or 0 for r in roles], np.int64)[code]
    neg, bst = (np.array([bool(r[i]) for r in roles], bool)[code] for i in (1, 2))
    at = np.flatnonzero(has | bst)  # the words that contribute
    v = np.where(bst[at], 0.0, val[at] / 1e9)
    for d in (1, 2, 3):
        before = np.maximum(at - d, 0)
        free = (at >= d) & (rows[before] == rows[at]) & ~has[before]
        increment = BOOSTER_INCREMENT * BOOSTER_DAMPING[d - 1]
        v = np.where(free & bst[before], v + np.where(v < 0, -increment, increment), v)
        v = np.where(free & neg[before], v * NEGATION_SCALAR, v)
    if contrast is not None and contrast in distinct:
        place = np.flatnonzero(code == distinct.index(contrast))
        of_row = np.full(len(texts), -1)
        of_row[rows[place[::-1]]] = place[::-1]  # the first one of a text is written last
        turn = of_row[rows[at]]
        v = np.where((turn >= 0) & (at < turn), v * BEFORE_CONTRAST, np.where((turn >= 0) & (at > turn), v * AFTER_CONTRAST, v))
    size = np.abs(v * 1e9)
    whole = np.floor(size).astype(np.int64)
    whole += size - whole >= 0.5
    total = np.zeros(len(texts), np.int64)
    np.add.at(total, rows[at], np.where(v >= 0, whole, -whole))
    return total


def _scorer(common: dict, contrast: str | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, ROWS_AT_ONCE) for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
                rare = [batch.column("rare").flatten().field(c).to_pylist() for c in ("token", *_ROLES)]
                own = {token: role for token, *role in zip(*rare, strict=True)}
                units = _units(batch.column("words"), common, own, contrast)
                yield pa.RecordBatch.from_arrays([batch.column("keep"), pa.array(units, pa.int64())], schema=pa.schema(
                    [batch.schema.field("keep"), ("units", pa.int64())]))
    return score


def _joined_context(words: TextWords, roles: DataFrame, contrast: str | None) -> DataFrame:
    """The context rules over written rows: common words by their roles in the task, rare ones by those joined to the row."""
    rows, often = words.rows, words.often(roles)
    some = often.filter(F.col("val").isNotNull() | F.col("neg") | F.col("bst")).collect()  # at most COMMON_PARTS words
    met = CW.with_rare(rows, T.spaced_words("words"), often, roles.select("token", *_ROLES), words.hot).select("keep", "words", "rare")
    kind = dict(met.dtypes)["keep"]
    scored = met.mapInArrow(_scorer({r.token: (r.val, r.neg, r.bst) for r in some}, contrast), f"keep {kind}, units long")
    return _finish(scored.select("keep.*", (F.col("units") / F.lit(1e9)).cast("double").alias("valence_sum")))


def sentiment_names(c) -> Column:
    """Code -> name through a literal map (no join)."""
    m = F.create_map(*[x for k, name in sorted(SENTIMENT_NAMES.items())
                       for x in (F.lit(k), F.lit(name))])
    return m[F.col(c) if isinstance(c, str) else c]


def sentiment_by_product(scored: DataFrame, group_col: str = "product",
                         label_col: str = "sentiment") -> DataFrame:
    """Share of each label within each group, wide (one column per label).

    Conditional counts in one aggregation (the fixed-value pivot); a label
    absent from a group gives NULL, as an unstacked value_counts does.
    """
    lab = F.col(label_col)
    aggs = [F.count("*").alias("_n")]
    for code, name in sorted(SENTIMENT_NAMES.items()):
        aggs.append(F.count(F.when(lab == code, 1)).alias(f"_c{code}"))
    g = scored.groupBy(group_col).agg(*aggs)
    cols = [F.col(group_col)]
    for code, name in sorted(SENTIMENT_NAMES.items()):
        cols.append(round6(F.nullif(F.col(f"_c{code}"), F.lit(0)) / F.col("_n"))
                    .alias(name.lower()))
    return g.select(*cols)
