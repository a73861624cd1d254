"""Licence scan: a sparse word n-gram logistic regression over paragraphs.

The classifier is trained on variants of the licence notices, on legal wording of no
family, and on lines of the corpus; its features are the words and word pairs of the
notices that are rare in ordinary text. Scoring is a join: every distinct n-gram of every
paragraph meets the coefficient table by hash, matches are summed per paragraph, and a
softmax gives the family. A family needs the probability calibrated on held-out rows and
a template of that family that the paragraph resembles; a licence-like paragraph without
both is ``unknown``.

DataFrame functions and the JVM learner only. The coefficient table has a fixed bound
(the notices are fixed) and is broadcast.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shown_id, stored
from .license_templates import TEMPLATES, UNKNOWN

NONE, UNDECIDED = "none", "unknown"
#: Bounds of the training set: documents whose paragraphs are ordinary text, variants a notice.
ORDINARY_DOCUMENTS, ORDINARY_PARAGRAPHS, VARIANTS = 400, 3000, 40
#: An n-gram in over this share of ordinary lines (and in more than one) is no feature, but
#: every notice keeps this many of its rarest.
MOST_COMMON, LEAST_FEATURES = 0.005, 4
#: Share of a template's features that a paragraph must have to confirm it.
LEAST_SIMILAR = 0.6
#: Notice n-grams that a line of a wrapped notice holds at least, besides half of its own.
DENSE_GRAMS = 6
#: Precision that the calibrated probability must reach on held-out rows.
PRECISION = 0.95


class Model(NamedTuple):
    families: list[str]
    intercepts: list[float]
    #: (h, weights): one row per feature; (family, hashes): one row per template.
    coefficients: DataFrame
    templates: DataFrame
    threshold: float
    #: The features' n-grams, at most those of the fixed notices.
    vocabulary: list[str]


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few driver-side rows as a frame, from one JSON literal: no Python worker is needed."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(parsed).alias("r")).select("r.*")


def once(df: DataFrame, **made: Column) -> DataFrame:
    """``df`` with further columns, each computed once.

    They pass through a generator: without it the optimiser copies an expression into every
    filter and expression that uses it, and a text is split hundreds of times.
    """
    kept = df.columns
    out = df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))).alias("_made"))
    return out.select(*kept, *[F.col(f"_made.{n}").alias(n) for n in made])


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _pairs(words: Column, join) -> Column:
    """``join`` of every two neighbouring words."""
    return F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), join)


def with_grams(df: DataFrame, words: str) -> DataFrame:
    """``df`` with ``singles`` and ``pairs``: hashes of the words and of the word pairs in column ``words``."""
    return once(df, singles=F.transform(words, lambda w: F.xxhash64(w)), pairs=_pairs(F.col(words), lambda a, b: F.xxhash64(a, b)))


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, pos, words): the non-blank lines."""
    lines = documents(docs, id_col, text_col).select("id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return once(lines.where(F.trim("line") != ""), words=words_of(F.col("line"))).drop("line")


def _variants(spark: SparkSession) -> DataFrame:
    """(family, words): each notice as it is, and with about one word in ten left out, at
    places that follow from a hash."""
    rows = [*TEMPLATES, *((UNDECIDED, t) for t in UNKNOWN)]
    notices = literal_rows(spark, [{"family": f, "notice": t} for f, t in rows], "family: string, notice: string")
    many = notices.select("family", words_of(F.col("notice")).alias("w"), F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v"))
    thin = F.filter("w", lambda x, i: (F.col("v") == 0) | (F.pmod(F.xxhash64(x, i, F.col("v")), F.lit(10)) > 0))
    return many.select("family", (F.col("v") == 0).alias("whole"), thin.alias("words"))


def _known(spark: SparkSession) -> tuple[DataFrame, dict[int, str], list[tuple[str, list[int], list[int]]]]:
    """The variants with their hashes; the n-grams by hash; (family, hashes, pair hashes) of each notice."""
    rows = _variants(spark)
    hashed = with_grams(rows, "words").select("family", "whole", "words", F.array_distinct(F.concat("singles", "pairs")).alias("grams"), "pairs")
    texts = F.concat(F.col("words"), _pairs(F.col("words"), lambda a, b: F.concat(a, F.lit(" "), b)))
    named = with_grams(rows, "words").select(F.explode(F.arrays_zip(F.concat("singles", "pairs").alias("h"), texts.alias("g"))).alias("x")).select("x.h", "x.g").distinct()
    every = [(r["family"], r["grams"], r["pairs"]) for r in hashed.where("whole").collect()]
    return hashed, {r["h"]: r["g"] for r in named.collect()}, every


def hits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, pos, n_words, n_pairs, held): every non-blank line with the hashes of the
    notices' n-grams in it. The one pass over the texts; both ``fit`` and ``scan`` read its rows."""
    known = sorted(_known(docs.sparkSession)[1])
    found = with_grams(lines_of(docs, id_col, text_col), "words")
    return found.select(
        "id", "text_key", "pos", F.size(F.array_distinct("singles")).alias("n_words"), F.size(F.array_distinct("pairs")).alias("n_pairs"),
        F.array_distinct(F.filter(F.concat("singles", "pairs"), lambda h: h.isin(known))).alias("held"),
    )


_LINE = ["id", "text_key", "pos"]


def _ordinary_counts(found: DataFrame, notices: list[tuple[str, list[int], list[int]]]) -> tuple[int, dict[int, int]]:
    """Ordinary lines of the whole corpus, and how many of them hold each n-gram.

    Set aside are lines with half of a notice's word pairs, and lines at least half of whose
    pairs, three or more, are those of one notice: parts of a wrapped one. Only lines with a
    notice's pair are shuffled; the rest is summed in the tasks.
    """
    spark = found.sparkSession
    pairs = [{"h": h, "notice": i, "least": len(set(p))} for i, (_, _, p) in enumerate(notices) for h in set(p)]
    table = F.broadcast(literal_rows(spark, pairs, "h: bigint, notice: int, least: int"))
    met = found.select(*_LINE, "n_pairs", "held", F.explode("held").alias("h")).join(table, "h")
    per = met.groupBy(*_LINE, "notice", "least", "n_pairs", "held").agg(F.collect_set("h").alias("both"), F.count(F.lit(1)).alias("rows"))
    both = F.size("both")
    like = (2 * both >= F.col("least")) | ((both >= 3) & (2 * both >= F.col("n_pairs")))
    aside = per.where(like).groupBy(*_LINE, "held").agg(F.max((F.col("rows") / both).cast("long")).alias("rows"))

    def counted(df: DataFrame, rows: Column) -> tuple[int, dict[int, int]]:
        each = df.select(F.explode(F.concat("held", F.array(F.lit(None).cast("bigint")))).alias("h"), rows.alias("rows"))
        sums = {r["h"]: r["n"] for r in each.groupBy("h").agg(F.sum("rows").alias("n")).collect()}
        return sums.pop(None, 0), sums

    n_all, every = counted(found, F.lit(1))
    n_aside, apart = counted(aside, F.col("rows"))
    return n_all - n_aside, {h: n - apart.get(h, 0) for h, n in every.items()}


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", found: DataFrame | None = None) -> Model:
    """Train on notices and on the lines of a bounded set of documents (the ids with the
    smallest hash); what is too common for a feature is counted over every line. An empty
    corpus leaves the notices alone to train on. ``found`` are the corpus's ``hits``, if there
    already."""
    spark = docs.sparkSession
    found = stored(hits(docs, id_col, text_col), "licence-hits") if found is None else found
    variants, names, notices = _known(spark)
    n_lines, counts = _ordinary_counts(found, notices)
    most = max(MOST_COMMON * n_lines, 1)
    kept = {h for h in names if counts.get(h, 0) <= most}
    for _, grams, _ in notices:  # no notice loses its last distinguishing n-grams
        kept |= set(sorted(grams, key=lambda h: (counts.get(h, 0), names[h]))[:LEAST_FEATURES])
    vocabulary = sorted(kept, key=names.get)
    whole = [{"family": f, "hashes": [h for h in grams if h in kept]} for f, grams, _ in notices if f != UNDECIDED]
    # Ordinary lines; those that hold some of a notice are not ordinary.
    ids = found.groupBy("id").agg(F.lit(1)).orderBy(F.xxhash64("id"), "id").limit(ORDINARY_DOCUMENTS).select("id")
    ordinary = found.join(F.broadcast(ids), "id").orderBy(F.xxhash64(*_LINE), *_LINE).limit(ORDINARY_PARAGRAPHS)
    of_templates = F.array(*[F.lit(h) for h in sorted({h for w in whole for h in w["hashes"]})])
    plain = ordinary.where(F.size(F.array_intersect("held", of_templates)) < 3)
    # A family's label is its place among the names; ordinary text comes first.
    families = [NONE, UNDECIDED, *sorted({f for f, _ in TEMPLATES})]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    rows = variants.select("family", "grams").union(plain.select(F.lit(NONE).alias("family"), F.col("held").alias("grams")))
    rows = rows.withColumn("grams", F.transform("grams", lambda h: h.cast("string")))
    # A few thousand rows by construction: one partition makes each step one small task.
    rows = CountVectorizerModel.from_vocabulary([str(h) for h in vocabulary], "grams", "features").setBinary(True).transform(
        rows.select("family", "grams", label.cast("double").alias("label"), (F.pmod(F.xxhash64("grams", F.lit(7)), F.lit(5)) == 0).alias("held_out"))
    ).coalesce(1).persist()
    learner = LogisticRegression(family="multinomial", elasticNetParam=0.5, regParam=0.0005, maxIter=60)
    fitted = learner.fit(rows.where("NOT held_out"))
    matrix, present = fitted.coefficientMatrix.toArray(), range(len(fitted.interceptVector))
    shown = fitted.transform(rows.where("held_out")).select(F.array_max(_vector(F.col("probability"))).alias("p"), "prediction", "label")
    outcome = sorted(((r["p"], r["prediction"] == r["label"]) for r in shown.where("prediction > 1").collect()), reverse=True)
    right, threshold = 0, 0.99
    for n, (p, ok) in enumerate(outcome, 1):  # the lowest probability down to which the precision holds
        right += ok
        if right >= PRECISION * n:
            threshold = p
    rows.unpersist()
    weighted = [{"h": h, "weights": [float(matrix[k][j]) for k in present]} for j, h in enumerate(vocabulary) if abs(matrix[:, j]).max() > 0]
    return Model(
        families[: len(present)], [float(x) for x in fitted.interceptVector], literal_rows(spark, weighted, "h: bigint, weights: array<double>"),
        literal_rows(spark, whole, "family: string, hashes: array<bigint>"), max(0.5, min(threshold, 0.99)), [names[r["h"]] for r in weighted],
    )


def _vector(c: Column) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(c)


def _runs(found: DataFrame) -> DataFrame:
    """(id, text_key, pos, run): lines made mostly of notice words that follow each other, two
    or more; ``run`` is the first one's number. The usual form of a wrapped notice."""
    dense = found.where((F.size("held") >= DENSE_GRAMS) & (2 * F.size("held") >= F.col("n_words") + F.col("n_pairs")))
    dense = dense.select(*_LINE, "held").dropDuplicates(_LINE)
    doc = Window.partitionBy("id", "text_key")
    islands = dense.withColumn("island", F.col("pos") - F.row_number().over(doc.orderBy("pos")))
    each = Window.partitionBy("id", "text_key", "island")
    joined = islands.select(*_LINE, "held", F.min("pos").over(each).alias("run"), F.count(F.lit(1)).over(each).alias("n_lines"))
    return joined.where("n_lines > 1")


def _scored(units: DataFrame, model: Model) -> DataFrame:
    """(id, text_key, pos, n_lines, guess, probability, similarity) of units that do not read like ordinary text."""
    key, k = [*_LINE, "n_lines"], len(model.families)
    # The table's size is bounded by the fixed notices.
    met = units.select(*key, F.explode("held").alias("h")).join(F.broadcast(model.coefficients), "h")
    sums = met.groupBy(*key).agg(
        F.collect_set("h").alias("found"), F.count(F.lit(1)).alias("rows"), *[F.sum(F.col("weights")[i]).alias(f"s{i}") for i in range(k)]
    )
    # Repeated rows of a document count once.
    times = F.col("rows") / F.size("found")
    sums = sums.select(*key, "found", F.array(*[F.col(f"s{i}") / times + model.intercepts[i] for i in range(k)]).alias("s"))
    sums = sums.withColumn("top", F.array_max("s"))
    named = sums.select(
        *key, "found", (1 / F.aggregate("s", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"),
        F.element_at(F.array(*[F.lit(f) for f in model.families]), F.array_position("s", F.col("top")).cast("int")).alias("guess"),
    ).where(F.col("guess") != NONE)
    templates = F.broadcast(model.templates.withColumnRenamed("family", "guess"))
    share = F.size(F.array_intersect("found", "hashes")) / F.size("hashes")
    return named.join(templates, "guess", "left").groupBy(*key, "guess", "probability").agg(F.coalesce(F.max(share), F.lit(0.0)).alias("similarity"))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", found: DataFrame | None = None) -> DataFrame:
    """(doc_id, pos, n_lines, family, probability, similarity): one row per line that is a licence
    notice, or ``unknown`` if it reads like one but no family is sure and confirmed.

    ``pos`` is the line's number from 0. Neighbouring lines made mostly of notice words are
    also read as one: if no line of theirs is confirmed by itself and together they are, they
    are one row of ``n_lines`` lines. Null and blank texts have no line; repeated rows give
    their rows once; a null id is shown as null. ``found`` are the documents' ``hits``, if
    there already.
    """
    found = stored(hits(docs, id_col, text_col), "licence-hits") if found is None else found
    runs = stored(_runs(found), "licence-runs")
    wrapped = runs.groupBy("id", "text_key", F.col("run").alias("pos")).agg(
        F.count(F.lit(1)).cast("int").alias("n_lines"), F.array_distinct(F.flatten(F.collect_list("held"))).alias("held")
    )
    units = found.select(*_LINE, F.lit(1).alias("n_lines"), "held").union(wrapped.select(*_LINE, "n_lines", "held"))
    sure = (F.col("guess") != UNDECIDED) & (F.col("probability") >= model.threshold) & (F.col("similarity") >= LEAST_SIMILAR)
    scored = _scored(units, model).withColumn("sure", sure)
    # Either a run or its lines are reported.
    scored = scored.join(runs.select(*_LINE, "run"), _LINE, "left")
    of_run = Window.partitionBy("id", "text_key", F.coalesce("run", "pos"))
    as_one = F.max((F.col("n_lines") > 1) & F.col("sure")).over(of_run) & ~F.max((F.col("n_lines") == 1) & F.col("sure")).over(of_run)
    kept = scored.withColumn("as_one", as_one).where((F.col("n_lines") > 1) == F.col("as_one"))
    return kept.select(
        shown_id().alias("doc_id"), "pos", "n_lines", F.when(F.col("sure"), F.col("guess")).otherwise(UNDECIDED).alias("family"), "probability", "similarity"
    )
