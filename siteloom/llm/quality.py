"""Quality by hashed n-grams: the log-likelihood ratio of a trusted multinomial against the whole corpus's.

Everything is column expressions. Words and pairs of neighbours are hashed to buckets, whose number grows with the
root of the corpus's bytes; a bucket's counts are summed in each task before they meet. The limit is the ratio that
nearly all trusted texts reach which weren't counted, so it means the same at every size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, thinned, words

#: Words of a repeated window.
WINDOW = 8
#: One trusted document in HELD, by a hash of the id, isn't counted but sets the limit: halfway from the ratio that all
#: but a share LOST of these reach down to the one that NOISE of the rejected rows stay below, if that is lower. Without
#: rejected rows it is the first, less MARGIN of the way from there to the median, as a few held rows say little about
#: their tail.
HELD, LOST, NOISE, MARGIN = 3, 0.005, 0.95, 0.5
#: Weight of the raw multinomial in the trusted one, as a share of its counts; it bounds what an unseen n-gram costs
#: alike at every size.
PRIOR = 0.25
#: Buckets of words are the power of two next to this many times the root of the bytes of all texts; pairs, most of
#: which are found once or twice, have half as many.
BUCKETS = 16
#: Most buckets of words whose ratios are broadcast, in some 100 MB with those of pairs; more are joined by shuffling.
BROADCAST = 1 << 20
#: Log-ratios are whole numbers of this share of a nat, so that their sums don't depend on the order.
PARTS = 1_000_000
#: Values that the driver sorts for a percentile, at most; width of the bins that rows are counted in before that, and
#: into how many a bin with more values is parted.
FEW, WIDTH, PARTED = 50_000, 1 / 64, 1024


def bound(value: Column, body) -> Column:
    """body of a value that is computed once a row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def grams(rows: DataFrame, text: str, buckets: int, *keep: str) -> DataFrame:
    """(*keep, bucket) of each word, below so many, and of each pair of neighbours, above; a row for every one."""
    split = rows.select(*keep, words(F.col(text)).alias("_word")).withColumn("_next", F.slice("_word", 2, (1 << 31) - 1))
    each = split.select(*keep, F.inline(F.arrays_zip("_word", "_next")))
    word = F.pmod(F.xxhash64("_word"), F.lit(buckets))
    pair = F.when(F.col("_next").isNotNull(), F.pmod(F.xxhash64("_word", "_next"), F.lit(buckets // 2)) + buckets)
    return each.select(*keep, F.explode(F.array(word.cast("int"), pair.cast("int"))).alias("bucket")).where("bucket is not null")


def repeat_words(ws: Column) -> Column:
    """Words in WINDOW-word windows that are found twice or more in the text."""
    windows = bound(ws, lambda w: F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))).otherwise(F.array().cast("array<bigint>")))

    def places(h: Column) -> Column:
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        return F.array_sort(F.transform(bound(by_hash, twice), lambda x: x["i"]))

    covered = lambda h: F.aggregate(
        places(h), F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n")), lambda s: s["n"])
    return bound(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))


def base(text: Column, ws: Column) -> dict[str, Column]:
    """The plain figures of a text."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    return {
        "n_words": F.size(ws).cast("long"),
        "word_chars": F.char_length(F.array_join(ws, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(ws),
    }


@dataclass
class Model:
    """ratios: (bucket, ratio), the log-ratio in PARTS of each bucket, of words so many; least: the limit of kept texts;
    scores: what scored() gives for the corpus, if the limit took it."""

    ratios: DataFrame
    buckets: int
    least: float
    scores: DataFrame | None = None


def ids_of(rows: DataFrame, doc_id: str, docs: DataFrame) -> DataFrame:
    """Distinct ids as _id, of the type that they have in docs, without null."""
    return rows.select(F.col(doc_id).cast(docs.schema[doc_id].dataType).alias("_id")).where("_id is not null").distinct()


def percentiles(rows: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Exact percentiles, in between two values by their distance; of any number of rows, as they are counted in bins
    and only the bin of a rank is looked into."""
    n, value = rows.count(), F.col(column)

    def ranked(rank: int, own: DataFrame, width: float = WIDTH) -> float:
        place = F.floor(value / width)
        for at, k in own.groupBy(place.alias("at")).agg(F.count(F.lit(1))).orderBy("at").collect():
            if rank < k:
                break
            rank -= k
        own = own.where(place == at)
        if k > FEW and width > 1e-13:
            return ranked(rank, own, width / PARTED)
        for x, k in sorted(own.groupBy(value).agg(F.count(F.lit(1))).collect()):
            if rank < k:
                return x
            rank -= k

    def percentile(share: float) -> float:
        low = math.floor(share * (n - 1))
        x = ranked(low, rows)
        return x if low == share * (n - 1) else x + (share * (n - 1) - low) * (ranked(low + 1, rows) - x)

    return [percentile(share) if n else None for share in shares]


def weights(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", rejected: DataFrame | None = None) -> Model:
    """The model of a corpus, of the trusted rows in it and, for the limit alone, of rows known to be bad.

    Counts cover all of docs, those of the trusted multinomial all trusted rows that aren't held, and the limit all held
    and all rejected ones. Without trusted rows every ratio is 0, and without held ones all texts are above the
    limit. Null ids are never trusted; repeated ones are once.
    """
    held = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(HELD)) == 0
    ids = ids_of(trusted, doc_id, docs)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = 1 << max(10, round(math.log2(BUCKETS * math.sqrt(size + 1))))
    # Only texts of trusted rows, and some others, are shuffled to meet the ids, in the same way at every size; the whole
    # corpus is counted where it is.
    counted = ids.where(~held).hint("shuffle_hash")
    told = thinned(rows.where("_id is not null"), F.col("_id"), counted, F.col("_id")).join(counted, "_id", "left_semi")
    each = grams(rows.withColumn("_in", F.lit(0)), "_text", buckets, "_in").unionByName(grams(told.withColumn("_in", F.lit(1)), "_text", buckets, "_in"))
    counts = stored(each.groupBy("bucket").agg(F.sum(1 - F.col("_in")).alias("all"), F.sum("_in").alias("some")))
    raw, trusted_ = (x or 0 for x in counts.agg(F.sum("all"), F.sum("some")).first())
    share = F.col("all") / F.lit(float(raw or 1))
    ratio = F.log((F.col("some") / F.lit(float(trusted_ or 1)) + PRIOR * share) / (1 + PRIOR)) - F.log(share)
    model = Model(counts.select("bucket", F.round(PARTS * ratio * int(trusted_ > 0)).cast("int").alias("ratio")), buckets, -math.inf)
    kinds = ids.where(held).withColumn("_good", F.lit(True))
    if rejected is not None:
        kinds = kinds.unionByName(ids_of(rejected, doc_id, docs).withColumn("_good", F.lit(False)))
    # Texts of 20 words or more; shorter ones fail anyhow.
    model.scores = stored(scored(rows, model, "_text"))
    texts = rows.select("_id", F.xxhash64("_text").alias("_key")).join(kinds, "_id").select("_key", "_good").distinct()
    own = stored(texts.join(model.scores.where("n >= 39"), "_key").select("_good", "llr"))
    tail, median = percentiles(own.where("_good"), "llr", [LOST, 0.5])
    if tail is None:
        return model
    noise = percentiles(own.where("not _good"), "llr", [NOISE])[0]
    model.least = tail - (MARGIN * (median - tail) if noise is None else max(0.0, tail - noise) / 2)
    return model


def scored(rows: DataFrame, model: Model, text: str, key: str = "_key") -> DataFrame:
    """(key, llr, n): the mean log-ratio and the number of a text's n-grams by its 64-bit hash; no row without any.

    A text's n-grams stand in one task, so what is shuffled for the sums is a row a text.
    """
    ratios = F.broadcast(model.ratios) if model.buckets <= BROADCAST else model.ratios
    found = grams(rows.withColumn(key, F.xxhash64(text)), text, model.buckets, key).join(ratios, "bucket", "left")
    mean = F.sum(F.coalesce("ratio", F.lit(0)).cast("long")) / F.lit(float(PARTS)) / F.count(F.lit(1))
    return found.groupBy(key).agg(mean.alias("llr"), F.count(F.lit(1)).alias("n"))


def judge(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", scores: DataFrame | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, the plain figures, base_failed, llr, kept.

    scores: what scored() gives for docs, if that is there already, as after weights() of the same docs.

    kept is false where base_failed, else llr >= the model's limit. Null and empty texts have no words and so fail.
    llr is 0 for a text without n-grams. Equal texts, by a 64-bit hash, are scored together; rows don't depend on each
    other otherwise. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    made = rows.select("doc_id", F.xxhash64("_text").alias("_key"), *(c.alias(k) for k, c in base(F.col("_text"), words(F.col("_text"))).items()))
    made = made.join((scored(rows, model, "_text") if scores is None else scores).select("_key", "llr"), "_key", "left").withColumn("llr", F.coalesce("llr", F.lit(0.0)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.col("llr") >= model.least)).alias("kept"), "llr")
