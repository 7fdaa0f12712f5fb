"""Language ID with interpolated Kneser-Ney character models.

A text is its words (runs of letters, lower-cased), each between a begin
and an end mark.  Per language, character n-grams up to ORDER are counted
over all learned rows: words first, then their n-grams, both as Spark
aggregates, so what is gathered follows the corpus.  Counts of lower orders
are the numbers of different preceding characters; each order takes one
absolute discount from its own counts of counts.

The model keeps at most MAX_GRAMS n-grams (the bound is a parameter), shared
fairly among the languages: one with few n-grams keeps them all, the others
their most frequent ones.  It is one sorted array of n-gram hashes and, per
language, the discounted share of the n-gram and the weight of the order
below it.  Whatever is not kept falls to the order below.  Shares, weights
and hashes are computed in Spark; the driver gets numbers only.

A text gets the language with the lowest cross-entropy per character.  It
is rejected when that is far above what the learned texts of the language
show at the same length: the variance is modelled as a + b / n over the
learned texts, and the limit is a multiple of their REJECT_QUANTILE.  Learned
texts that are far from the median of their language do not count there:
labels on junk must not teach the limit to accept it.

Defined results: a null text, or one without a letter, is `und` with score
0 and rejected; equal cross-entropies go to the first language in order;
without any learned row everything is `und`; repeated rows are judged
each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kcflow.llm.common import arrow_batches, materialise, packed

ORDER = 4
MAX_GRAMS = 1_000_000
UNDETERMINED = "und"
REJECT_QUANTILE = 0.999
REJECT_FACTOR = 1.5
#: Least distance of a rejected text, in standard deviations.
REJECT_LEAST = 6.0
#: Learned texts beyond so many robust standard deviations (each counted as this much at
#: least) are noise.
NOISE, LEAST_SCALE = 8.0, 0.05
#: Characters after which the score takes the evidence as complete.
SCORE_CHARS = 32
#: Words whose scores a worker keeps, and characters of text it takes at once.
CACHE_WORDS = 200_000
TAKE_CHARS = 1_000_000
#: Words scored at once.
SCORE_WORDS = 20_000

BEGIN, END = "\x02", "\x03"
_WORD = re.compile(r"[^\W\d_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Its words; none if it has digits and the like, but no letter."""
    found = _WORD.findall(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


def _parts(texts: list[str | None]) -> Iterator[slice]:
    lo = 0
    while lo < len(texts):
        size, hi = 0, lo
        while hi < len(texts) and (size < TAKE_CHARS or hi == lo):
            size += len(texts[hi] or "")
            hi += 1
        yield slice(lo, hi)
        lo = hi


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) of rows (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in _parts(texts):
                by: dict[str, Counter] = defaultdict(Counter)
                for lang, text in zip(langs[part], texts[part], strict=True):
                    by[lang].update(words(text))
                for lang, c in by.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()),
                         pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    return (labelled.mapInArrow(count, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def gram_counts(counted: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): n-grams of 1 to `order` characters that end in a word."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, Counter] = defaultdict(Counter)
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marked, c = BEGIN + word + END, by[lang]
                for end in range(2, len(marked) + 1):
                    for k in range(1, min(order, end) + 1):
                        c[marked[end - k:end]] += n
            for lang, c in by.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()),
                     pa.array(list(c.values()), pa.int64())], names=["lang", "gram", "n"])

    return (counted.mapInArrow(grams, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def hash_grams(grams: list[str]) -> np.ndarray:
    """The same hash that `Model.lookup` rolls along a word."""
    out = np.zeros(len(grams), np.uint64)
    with np.errstate(over="ignore"):
        for i, g in enumerate(grams):
            h = np.uint64(0)
            for ch in g:
                h = (h + np.uint64(ord(ch) + 1)) * _STEP
                h ^= h >> np.uint64(29)
            out[i] = h
    return out


class Model:
    """Sorted n-gram hashes with one column per language.

    share[i, l]: discounted share of n-gram i after its context;
    below[i, l]: weight of the next lower order after n-gram i as a context.
    """

    def __init__(self, langs: list[str], grams: pd.DataFrame, order: int, alphabet: int):
        """grams: lang, key (hash as a signed long), share (0 for contexts only), below (1 if
        never one)."""
        self.langs, self.order, self.floor = langs, order, 1.0 / max(1, alphabet)
        self.keys, i = np.unique(grams["key"].to_numpy(np.int64).view(np.uint64),
                                 return_inverse=True)
        self.share = np.zeros((self.keys.size + 1, len(langs)))
        self.below = np.ones((self.keys.size + 1, len(langs)))  # the last row: unknown
        lang_at = {x: i for i, x in enumerate(langs)}
        j = grams["lang"].map(lang_at).to_numpy(np.int64)
        self.share[i, j] = grams["share"].to_numpy()
        self.below[i, j] = grams["below"].to_numpy()
        #: the empty context, per language
        self.root = np.ones(len(langs))
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(langs)))

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "scores": self.scores[:0]}

    def lookup(self, h: np.ndarray) -> np.ndarray:
        if not self.keys.size:
            return np.full(h.size, -1)
        i = np.minimum(np.searchsorted(self.keys, h), self.keys.size - 1)
        return np.where(self.keys[i] == h, i, -1)

    def score(self, new: list[str]) -> np.ndarray:
        """Natural log probability of each word per language."""
        marked = [BEGIN + w + END for w in new]
        n = np.array([len(m) for m in marked])
        chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        place = np.arange(chars.size) - np.repeat(first, n)  # position in its word
        prob = np.full((chars.size, len(self.langs)), self.floor)
        with np.errstate(over="ignore"):
            # h[k]: hash of the k characters that end here; context: the k - 1 before
            context = np.full(chars.size, -2)  # row of the empty context
            h = np.zeros(chars.size, np.uint64)
            for k in range(1, self.order + 1):
                if k > 1:
                    h = np.concatenate((np.zeros(1, np.uint64), h[:-1]))
                h = (h + chars + np.uint64(1)) * _STEP
                h ^= h >> np.uint64(29)
                row = self.lookup(h)
                below = self.root if k == 1 else self.below[context]
                mixed = self.share[row] + below * prob
                use = place >= k - 1
                prob = np.where(use[:, None], mixed, prob)
                context = np.concatenate(([-1], row[:-1]))
        log = np.log(prob)
        log[place == 0] = 0.0  # the begin mark is given
        return np.add.reduceat(log, first, axis=0) if len(new) else log

    def word_scores(self, different: list[str]) -> np.ndarray:
        if len(self.known) + len(different) > CACHE_WORDS:
            self.known, self.scores = {}, self.scores[:0]
        new = [w for w in different if w not in self.known]
        if new:
            for w in new:
                self.known[w] = len(self.known)
            self.scores = np.concatenate((self.scores, *(
                self.score(new[i:i + SCORE_WORDS]) for i in range(0, len(new), SCORE_WORDS))))
        return self.scores[[self.known[w] for w in different]]

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character and language, and the characters, of each text."""
        found = [words(t) for t in texts]
        n = np.array([len(x) for x in found], np.int64)
        total = np.zeros((len(texts), len(self.langs)))
        chars = np.zeros(len(texts))
        flat = [w for x in found for w in x]
        if flat:
            codes, different = pd.factorize(np.array(flat, dtype=object))
            scores = self.word_scores(list(different))
            size = np.array([len(w) + 1 for w in different])
            text = np.repeat(np.arange(len(texts)), n)
            chars = np.bincount(text, size[codes], minlength=len(texts))
            for j in range(len(self.langs)):
                total[:, j] = np.bincount(text, scores[codes, j], minlength=len(texts))
        return -total / np.maximum(chars, 1)[:, None], chars


def fit(labelled: DataFrame, order: int = ORDER, max_grams: int = MAX_GRAMS) -> Model | None:
    """The model of rows (lang, text); None without any word."""
    spark = labelled.sparkSession
    raw = materialise(gram_counts(word_counts(labelled), order), "grams")
    size = F.length("gram")
    preceded = (raw.where(size > 1).groupBy("lang", F.substring("gram", 2, order).alias("gram"))
                .agg(F.count(F.lit(1)).alias("before")))
    whole = (size == order) | F.col("gram").startswith(BEGIN)
    adjusted = materialise(
        raw.join(preceded, ["lang", "gram"], "left").select(
            "lang", "gram", "n", size.alias("k"),
            F.when(whole, F.col("n")).otherwise(F.coalesce("before", F.lit(1))).alias("a")),
        "adjusted")
    # aggregates with one row per language and order, or a fixed number of columns
    discounts = adjusted.groupBy("lang", "k").agg(
        F.count_if(F.col("a") == 1).alias("n1"), F.count_if(F.col("a") == 2).alias("n2"))
    # one row per language
    sizes = {r["lang"]: r[1:] for r in adjusted.groupBy("lang").agg(
        *[F.count_if(F.col("n") >= 2**j).alias(f"c{j}") for j in range(40)]).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    cuts = spark.createDataFrame(list(cut_offs(sizes, max_grams).items()), "lang string, cut long")
    of_context = adjusted.groupBy("lang", F.expr("substring(gram, 1, k - 1)").alias("context")).agg(
        F.sum("a").alias("total"))
    share = F.greatest(F.col("a") - F.col("d"), F.lit(0.0)) / F.col("total")
    kept = materialise(
        adjusted.join(F.broadcast(cuts), "lang").where(F.col("n") >= F.col("cut"))
        .withColumn("context", F.expr("substring(gram, 1, k - 1)"))
        .join(of_context, ["lang", "context"])
        .join(F.broadcast(discounts.select(  # one row per language and order
            "lang", "k", F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2")))
            .otherwise(F.lit(0.5)).alias("d"))), ["lang", "k"])
        .select("lang", "gram", "context", share.alias("share")), "shares")
    # what a context's kept n-grams leave goes to the order below
    left = kept.groupBy("lang", F.col("context").alias("gram")).agg(
        F.greatest(1.0 - F.sum("share"), F.lit(1e-9)).alias("below"))
    nothing = F.lit(None).cast("double")
    rows = materialise(
        kept.select("lang", "gram", "share", nothing.alias("below"))
        .unionByName(left.select("lang", "gram", nothing.alias("share"), "below"))
        .groupBy("lang", "gram").agg(F.max("share").alias("share"), F.max("below").alias("below"))
        .select("lang", "gram", F.coalesce("share", F.lit(0.0)).alias("share"),
                F.coalesce("below", F.lit(1.0)).alias("below")), "model")
    root = {r["lang"]: r["below"] for r in rows.where("gram = ''").collect()}  # one a language
    numbers = rows.where("gram != ''").mapInArrow(
        _keys, "lang string, key long, share double, below double").toPandas()
    last = kept.agg(F.count_distinct(F.substring("gram", -1, 1))).first()[0]
    model = Model(langs, numbers, order, last)
    model.root = np.array([root.get(x, 1.0) for x in langs])
    return model


def cut_offs(sizes: dict[str, tuple[int, ...]], max_grams: int) -> dict[str, int]:
    """The count from which a language's n-grams are kept; sizes[lang][j] of them have a
    count of 2^j or more.

    The smallest languages choose first, each from an equal part of what is left.
    """
    cuts, room = {}, max_grams
    by_size = sorted(sizes, key=lambda x: (sizes[x][0], x))
    for i, lang in enumerate(by_size):
        part = room // (len(by_size) - i)
        j = next((j for j, c in enumerate(sizes[lang]) if c <= part), len(sizes[lang]))
        cuts[lang] = 2**j
        room -= sizes[lang][j] if j < len(sizes[lang]) else 0
    return cuts


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, gram, share, below) with the hash of the n-gram in its place."""
    for batch in batches:
        keys = hash_grams(batch.column(1).to_pylist()).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.int64()), batch.column(2), batch.column(3)],
            names=["lang", "key", "share", "below"])


def identify(docs: DataFrame, learn: Column, lang: str = "lang", text: str = "text",
             order: int = ORDER, max_grams: int = MAX_GRAMS) -> DataFrame:
    """`row` (the input row as a struct), lang_pred, score (0 to 1), entropy
    (per character), n_letters and rejected.

    `learn` marks the rows whose text and lang may be learned from.
    """
    spark = docs.sparkSession
    learned = learn & F.col(f"`{lang}`").isNotNull()
    labelled = docs.where(learned).select(F.col(f"`{lang}`").cast("string").alias("lang"),
                                          F.col(f"`{text}`").alias("text"))
    with arrow_batches(spark):
        model = fit(labelled, order, max_grams)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, entropy double, n_letters long")
    def judged(body: pd.Series) -> pd.DataFrame:
        own, texts, out = shared.value, body.tolist(), []
        for part in _parts(texts):
            some = texts[part]
            if own is None:
                out.append(pd.DataFrame({"lang_pred": UNDETERMINED, "score": 0.0, "entropy": None,
                                         "n_letters": [0] * len(some)}))
                continue
            entropy, chars = own.entropies(some)
            best = entropy.argmin(axis=1)
            low = entropy[np.arange(len(some)), best]
            odds = np.exp((low[:, None] - entropy) * np.minimum(chars, SCORE_CHARS)[:, None])
            named = chars > 0
            out.append(pd.DataFrame({
                "lang_pred": np.where(named, np.array(own.langs, object)[best], UNDETERMINED),
                "score": np.where(named, 1.0 / odds.sum(axis=1), 0.0),
                "entropy": np.where(named, low, np.nan), "n_letters": chars.astype(np.int64)}))
        columns = ["lang_pred", "score", "entropy", "n_letters"]
        return pd.concat(out, ignore_index=True)[columns] if out else pd.DataFrame(columns=columns)

    with arrow_batches(spark):
        scored = materialise(docs.select(packed(docs).alias("row"), learned.alias("learned"),
                                         judged(F.col(f"`{text}`")).alias("j"))
                             .select("row", "learned", "j.*"), "languages")
    shared.destroy()  # the judgements are written
    shape = limits(scored.where("learned and n_letters > 0"))
    distance = _distance(F.col("entropy"), F.col("n_letters"))
    far = F.coalesce(distance > F.col("most"), F.lit(False))
    return scored.join(F.broadcast(shape), "lang_pred", "left").select(  # a row per language
        "row", "lang_pred", "score", "entropy", "n_letters",
        ((F.col("lang_pred") == UNDETERMINED) | far).alias("rejected"))


def _distance(entropy: Column, n: Column) -> Column:
    """Standard deviations above the language's mean at this length."""
    return (entropy - F.col("mean")) / F.sqrt(F.col("a") + F.col("b") / n)


def without_noise(learned: DataFrame) -> DataFrame:
    """The learned rows that are near the median of their language.

    The scale at a length n is robust as well: the median deviation, and the median of
    deviation times sqrt(n) divided by sqrt(n), added as variances.  All of it holds
    while less than half of a language's learned texts are noise.
    """
    middle = learned.groupBy("lang_pred").agg(F.percentile_approx("entropy", 0.5).alias("middle"))
    off = learned.join(F.broadcast(middle), "lang_pred").withColumn(  # a row per language
        "off", F.abs(F.col("entropy") - F.col("middle")))
    usual = off.groupBy("lang_pred").agg(
        F.greatest(1.4826 * F.percentile_approx("off", 0.5), F.lit(LEAST_SCALE)).alias("long"),
        (1.4826 * F.percentile_approx(F.col("off") * F.sqrt("n_letters"), 0.5)).alias("short"))
    scale = F.sqrt(F.col("long") * F.col("long") + F.col("short") * F.col("short")
                   / F.col("n_letters"))
    return off.join(F.broadcast(usual), "lang_pred").where(
        F.col("off") <= NOISE * scale).drop("middle", "off", "long", "short")


def limits(learned: DataFrame) -> DataFrame:
    """Per language: mean, a, b and the distance from which texts are rejected."""
    learned = without_noise(learned)
    mean = learned.groupBy("lang_pred").agg(F.avg("entropy").alias("mean"))
    square = learned.join(F.broadcast(mean), "lang_pred").withColumn(
        "sq", F.pow(F.col("entropy") - F.col("mean"), 2)).withColumn("x", 1 / F.col("n_letters"))
    shape = square.groupBy("lang_pred", "mean").agg(
        F.greatest(F.coalesce(F.regr_intercept("sq", "x"), F.lit(0.0)), F.lit(1e-4)).alias("a"),
        F.greatest(F.coalesce(F.regr_slope("sq", "x"), F.lit(0.0)), F.lit(1e-2)).alias("b"))
    far = learned.join(F.broadcast(shape), "lang_pred").withColumn(
        "z", _distance(F.col("entropy"), F.col("n_letters")))
    most = far.groupBy("lang_pred").agg(F.greatest(
        F.percentile_approx("z", REJECT_QUANTILE) * REJECT_FACTOR,
        F.lit(REJECT_LEAST)).alias("most"))
    return shape.join(most, "lang_pred")
