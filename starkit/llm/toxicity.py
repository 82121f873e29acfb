"""Toxicity by gradient-boosted trees over dense features, calibrated.

The fit takes a sample of the labelled training rows, at most
``FIT_ROWS`` of them, those with the least hashes of their ids.  By another
hash these go to three parts: one gives the lexicon, one the trees, one the
isotonic calibration, so none is fitted to what another was fitted to.

* Lexicon: words that occur in more toxic than other documents, by the log
  odds of their document counts; words are compared without obfuscation.
* Features of a text: lexicon densities (also by weight, and near a second
  person pronoun), share of capitals, punctuation, obfuscated and stretched words.
* Trees and calibration are Spark ML's; scoring runs in the JVM.

Labels, language, source and id are never features.  Defined results: a null
or empty text has features of 0 and gets a score like any other; a null id is
in the split as the empty string; labels without a document, or null, are
left out; without labels of both kinds every score is the share of toxic rows;
an empty table gives an empty result; repeated rows are scored each; other
columns are untouched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import packed, saved, small
from starkit.llm.lm_scoring import split_of

FIT_ROWS = 24_000
LEXICON_WORDS = 400     # of the largest weights
LEAST_DOCS = 3          # toxic documents a word must occur in,
LEAST_SHARE = 0.01      # and share of them
LEAST_ODDS = 1.0        # log odds ratio
THRESHOLD = 0.3
TREES, DEPTH = 30, 4
NEAR = 5                # words to a second person pronoun

#: Second person pronouns of four languages.
SECOND_PERSON = {
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "deinen", "ihr", "euch",
    "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros",
}
#: What is written for a letter.
OBFUSCATED = str.maketrans("013457@$!", "oleasta" + "si")
EDGES = ".,;:!?\"'()[]{}<>«»„“”…-_*#|/\\"
STRETCHED = re.compile(r"(\w)\1{2,}")
MARKS = re.compile(r"[!?]{2,}")
INSIDE = re.compile(r"[^\W\d_][0-9@$!*_.\-]+[^\W\d_]")


def plain(word: str) -> str:
    """A word without case, edge punctuation, obfuscation and stretching."""
    w = word.strip(EDGES).lower()
    if not w.isalpha():
        w = w.translate(OBFUSCATED)
        w = "".join(c for c in w if c.isalpha())
    return STRETCHED.sub(r"\1", w) if len(w) > 2 else w


FEATURES = ["density", "weight", "strongest", "distinct", "near_you", "second_person", "spelled", "capitals", "shouted",
            "exclaimed", "asked", "mark_runs", "points", "obfuscated", "stretched", "word_length", "length"]


class Plain(dict):
    def __missing__(self, word: str) -> str:
        if len(self) > 300_000:
            self.clear()
        self[word] = w = plain(word)
        return w


#: Whether a code point is an upper-case character.
UPPER = np.fromiter((chr(i).isupper() for i in range(0x110000)), bool, 0x110000)


def capitals(text: str) -> int:
    """Number of upper-case characters, by one array pass at every length."""
    return int(UPPER[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].sum())


def features_of(text, lexicon: dict[str, float], plains: Plain) -> list[float]:
    words = text.split() if isinstance(text, str) else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    p = [plains[w] for w in words]
    hits = [(i, lexicon[w]) for i, w in enumerate(p) if w in lexicon]
    you = [i for i, w in enumerate(p) if w in SECOND_PERSON]
    near = 0
    if hits and you:
        at = np.searchsorted(you, [i for i, _ in hits])
        near = sum(min(abs(you[min(k, len(you) - 1)] - i), abs(you[max(k - 1, 0)] - i)) <= NEAR for (i, _), k in zip(hits, at.tolist()))
    singles = "".join(w if len(w) == 1 else " " for w in p)  # words spelled out, letter by letter
    chars = len(text)
    upper = sum(map(str.isupper, words))
    return [
        100 * len(hits) / n, 100 * sum(w for _, w in hits) / n, max((w for _, w in hits), default=0.0), float(len({p[i] for i, _ in hits})),
        100 * near / n, 100 * len(you) / n, float(sum(x in lexicon for x in singles.split() if len(x) > 2)),
        capitals(text) / chars, upper / n, 100 * text.count("!") / n, 100 * text.count("?") / n, 100 * len(MARKS.findall(text)) / n,
        100 * sum(map(text.count, ".,;:")) / n, 100 * sum(bool(INSIDE.search(w)) for w in words if not w.isalpha()) / n,
        100 * len(STRETCHED.findall(text)) / n, chars / n, math.log1p(n),
    ]


def features_udf(lexicon):
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        plains = Plain()
        for texts in batches:
            yield pd.Series([features_of(t, lexicon.value, plains) for t in texts])
    return run


def plain_words():
    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        plains = Plain()
        for texts in batches:
            yield pd.Series([sorted({plains[w] for w in t.split()}) if isinstance(t, str) else [] for t in texts])
    return run


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of at most LEXICON_WORDS words, from rows (text, toxic)."""
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad:
        return {}
    words = rows.select("toxic", F.explode(plain_words()("text")).alias("word")).filter("length(word) > 2")
    counts = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    best = counts.filter(F.col("bad") >= max(LEAST_DOCS, math.ceil(LEAST_SHARE * bad))).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    return {r["word"]: r["odds"] for r in best.orderBy(F.desc("odds"), "word").limit(LEXICON_WORDS).collect()}


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row doc_id, held_out, score (0 to 1) and predicted (0 or 1)."""
    spark = docs.sparkSession
    docs = packed(docs).select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.text").alias("text"))
    known = packed(labels).select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic in (0, 1)").filter(split_of(F.col("doc_id"), folds) != held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = saved(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "fit-ids")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(20))
    rows = docs.join(small(sample), "doc_id").withColumn("part", part)
    rows = saved(rows, "fit-rows").coalesce(6)

    lexicon = spark.sparkContext.broadcast(learn_lexicon(rows.filter("part < 8")))
    with_features = rows.withColumn("x", features_udf(lexicon)("text")).select("part", F.col("toxic").cast("double").alias("toxic"), "x")
    with_features = saved(with_features, "fit-features").select("part", "toxic", array_to_vector("x").alias("x")).coalesce(4)
    fit, rest = with_features.filter("part between 8 and 15"), with_features.filter("part > 15")
    kinds = [{r["toxic"] for r in x.select("toxic").distinct().collect()} for x in (fit, rest)]
    out = docs.select("doc_id", (split_of(F.col("doc_id"), folds) == held_out).alias("held_out"), features_udf(lexicon)("text").alias("x"))
    if len(kinds[0]) < 2:
        share = with_features.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
        out = out.withColumn("score", F.lit(float(share)))
    else:
        trees = GBTClassifier(featuresCol="x", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, subsamplingRate=0.8, seed=7).fit(fit)
        chance = vector_to_array("probability")[1]
        out = trees.transform(out.withColumn("x", array_to_vector("x"))).withColumn("__c", chance)
        if len(kinds[1]) == 2:
            calibrate = trees.transform(rest).select("toxic", chance.alias("__c"))
            isotonic = IsotonicRegression(featuresCol="__c", labelCol="toxic", predictionCol="calibrated").fit(calibrate)
            # the step function ties what lies on one step; the trees' order stays within it
            out = isotonic.transform(out).withColumn("score", 0.98 * F.col("calibrated") + 0.02 * F.col("__c"))
        else:
            out = out.withColumn("score", F.col("__c"))
    value = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
    return out.select("doc_id", "held_out", value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted"))
