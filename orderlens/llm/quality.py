"""Quality classifier: interpolated modified Kneser-Ney over characters, trained on trusted text.

A text is the sequence of its words' characters, each word with an end mark, after start marks,
so the last characters of a word and where it ends tell how the next one begins; a word that
repeats the one before it is a mark of its own, and one that repeats it again is another,
so runs of one word are as unlikely as they should be. The grams of trusted documents (quality
label 1) are counted per block, summed by gram, and turned into discounted probabilities and
backoff weights of all orders. A Bloom filter of fixed size keeps most other documents out of
that shuffle; what it lets through is told apart inside the block. The model is never sent around
whole: each block asks the shards of `blocks` for the
distinct grams its own text has, and the counts meet the questions shard by shard.

A document is accepted while its log perplexity per character is at most its language's
threshold: MARGIN above the QUANTILE of the trusted documents of that language that were held
out of training. Languages with fewer than ENOUGH of those, none and null included, use the
greater of their own and all languages' quantile, and FEW_MARGIN above it, as a model that saw
little of a language finds its good text less likely, too. Neither depends on their number.

Defined results: null and empty texts have no characters, no perplexity, and are accepted, as
nothing speaks against them; a doc_id with contradicting labels is not trusted; null labels and
ids teach nothing; a null language is a language of its own; without trusted documents all
characters are equally likely and all documents are accepted, as they are if none was held out. Repeated rows are judged alike.
Columns other than those asked for are ignored; clashing names are the caller's to rename.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm import blocks
from orderlens.llm import words as W
from orderlens.operators.small import few
from orderlens.session import cut_lineage

ORDER = 5
QUANTILE, MARGIN, FEW_MARGIN = 0.99, 0.25, 0.3
ENOUGH = 30
#: One trusted document in so many is held out of training, for the thresholds.
HELD_OUT = 8
BLOOM_BITS = 24
#: Bits of one bitmap of Spark's.
PART_BITS = 32_768
BLOCK_BYTES = 8_000_000
START, END, REPEAT, RUN, ODD = "\x02", "\x03", "\x01", "\x05", "\x06"
#: Probabilities travel as logarithms in steps of 1 / FINE; 0 stands for none.
FINE, LEAST = 2_500.0, -26.0
_RECORD = np.dtype([("a", "<u2"), ("g", "<u2")])
_SALT = [np.uint64((k + 1) * 0xBF58476D1CE4E5B9 % 2**64) for k in range(ORDER + 1)]
MODEL = "shard long, key long, a int, g int"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0


def keys(*symbols: np.ndarray, size: int = 0) -> np.ndarray:
    """A hash of 56 bits per row of columns of code points.

    A gram that a model of n grams does not have is taken for one of them with probability
    n / 2**56; the eight bits left out need not be sent.
    """
    out = np.full(len(symbols[0]) if symbols else size, _SALT[len(symbols)])
    for column in symbols:
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += column
        out += np.uint64(1)
    return W.mixed(out) & ~np.uint64(255)


def coded(chance: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        logs = np.log(chance)
    return np.where(chance > 0, np.clip(np.rint((logs - LEAST) * FINE), 1, 65_535), 0).astype("<u2")


_CHANCE = np.exp(np.arange(65_536) / FINE + LEAST)
_CHANCE[0] = 0.0


def _points(words: pa.Array) -> np.ndarray:
    """Code points of the words, each followed by one more."""
    if not len(words):
        return np.zeros(0, np.uint32)
    bounds = pa.array([0, len(words)], pa.int64())
    joined = pc.binary_join(pa.LargeListArray.from_arrays(bounds, words), pa.scalar(END, words.type))
    return np.frombuffer((joined[0].as_py() + END).encode("utf-32-le"), "<u4").copy()


def _gram_hashes(points: np.ndarray, step: int = 2**17) -> np.ndarray:
    """A hash of each ORDER neighbouring code points, a stretch at a time to stay in cache."""
    out = np.empty(max(0, len(points) - ORDER + 1), np.uint64)
    for begin in range(0, len(out), step):
        own = points[begin : begin + step + ORDER - 1].astype(np.uint64)
        size = len(own) - ORDER + 1
        hashed = np.zeros(size, np.uint64)
        for k in range(0, ORDER, 3):  # three code points fit in 63 bits
            packed = np.zeros(size, np.uint64)
            for j in range(k, min(k + 3, ORDER)):
                packed = packed << np.uint64(21) | own[j : j + size]
            hashed = W.mixed((hashed + packed) * _SALT[1])
        out[begin : begin + size] = hashed
    return out


class Text:
    """Documents as one row of symbols, and the distinct grams that end at them.

    Each document is led in by start marks, which are not predicted.
    """

    def __init__(self, texts: pa.Array):
        begins, flat = W.split(texts)
        n, docs = len(flat), len(begins) - 1
        again = np.zeros(n, bool)
        again[1:] = pc.equal(flat.slice(1), flat.slice(0, max(0, n - 1))).to_numpy(zero_copy_only=False)
        again[begins[:-1][np.diff(begins) > 0]] = False
        run = again.copy()
        run[1:] &= again[:-1]
        lead = begins[:-1] + np.arange(docs)
        place = np.insert(np.where(again, n, np.arange(n)), begins[:-1], n + 1)
        words = pa.concat_arrays([flat, pa.array([REPEAT, START * (ORDER - 2)], flat.type)]).take(pa.array(place))
        stops = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        points = _points(words)
        points[points <= ord(ODD)] = ord(ODD)
        points[stops - 1] = ord(END)
        for mark, which in ((REPEAT, again & ~run), (RUN, run)):
            points[stops[np.insert(which, begins[:-1], False)] - 2] = ord(mark)
        predicted = np.ones(len(points), bool)
        for k in range(1, ORDER):
            points[stops[lead] - k] = ord(START)
            predicted[stops[lead] - k] = False
        ends = stops[np.append(lead[1:], len(words)) - 1] if docs else stops
        self.size = np.diff(ends, prepend=0) - (ORDER - 1)
        code = pa.array(_gram_hashes(points)[predicted[ORDER - 1 :]]).dictionary_encode()
        self.gram = code.indices.to_numpy()
        # codes are given out in the order in which grams appear
        first = np.flatnonzero(np.diff(np.maximum.accumulate(self.gram), prepend=-1))
        at = np.flatnonzero(predicted)[first]
        self.grams = np.stack([points[at - ORDER + 1 + k] for k in range(ORDER)], axis=1)

    def counts(self) -> np.ndarray:
        """Occurrences of each gram."""
        return np.bincount(self.gram, minlength=len(self.grams)).astype(np.int64)

    def strings(self) -> np.ndarray:
        return self.grams.view(f"<U{ORDER}").ravel()

    def parts(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Keys of each gram's ends, one symbol and longer, and of its contexts, none and longer."""
        g = [np.ascontiguousarray(c) for c in self.grams.T]
        ends = [keys(*g[ORDER - k :]) for k in range(1, ORDER + 1)]
        contexts = [keys(*g[ORDER - 1 - k : ORDER - 1], size=len(self.grams)) for k in range(ORDER)]
        return ends, contexts

    def questions(self) -> np.ndarray:
        ends, contexts = self.parts()
        every = np.sort(np.concatenate([*ends, *contexts]))
        return every[np.diff(every, prepend=every[:1] + np.uint64(1)) != 0]

    def log_probability(self, asked: np.ndarray, said: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and log probability of each document."""
        ends, contexts = self.parts()
        chance = np.ones(len(self.grams))  # the uniform part; its share is in the empty context
        for end, context in zip(ends, contexts):
            a = _CHANCE[said["a"][np.searchsorted(asked, end)]]
            chance = a + _CHANCE[said["g"][np.searchsorted(asked, context)]] * chance
        per_gram = np.log(np.maximum(chance, np.finfo(float).tiny))
        some = np.flatnonzero(self.size > 0)
        total = np.zeros(len(self.size))
        if len(some):
            begins = np.cumsum(self.size) - self.size
            total[some] = np.add.reduceat(per_gram[self.gram], begins[some])
        return self.size, total


def trusted_marks(labels: DataFrame, bounds: list[int]) -> DataFrame:
    """(block, doc_id) of the trusted documents that teach."""
    cuts = np.array(bounds, np.int64)
    chosen = trusted(labels).where(~held_out(F.col("doc_id"))).select("doc_id")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.searchsorted(cuts, W.ids(batch.column("doc_id")), side="right")
            yield pa.record_batch([pa.array(block), batch.column("doc_id")], names=["block", "doc_id"])

    return chosen.mapInArrow(place, "block long, doc_id long")


def likely(ids: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A Bloom filter of the ids: never False for one of them, seldom True for another."""

    def places(ids: np.ndarray) -> np.ndarray:
        first = W.mixed(ids.astype(np.uint64))
        return np.stack([W.mixed(first + np.uint64(k)) >> np.uint64(64 - BLOOM_BITS) for k in range(3)])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = places(W.ids(batch.column("doc_id"))).ravel().astype(np.int64)
            yield pa.record_batch([pa.array(at // PART_BITS), pa.array(at % PART_BITS)], names=["part", "bit"])

    parts = ids.mapInArrow(bits, "part long, bit long").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    whole = np.zeros((2**BLOOM_BITS // PART_BITS, PART_BITS // 8), np.uint8)
    for part, data in parts.collect():  # at most all parts, of fixed size
        whole[part] = np.frombuffer(data, np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(blocks.squeezed(whole))
    opened: list[np.ndarray] = []

    def wanted(ids: np.ndarray) -> np.ndarray:
        if not opened:
            opened.append(np.unpackbits(blocks.spread(shared.value, np.uint8), bitorder="little").astype(bool))
        return opened[0][places(ids)].all(axis=0)

    return wanted


def trusted(labels: DataFrame) -> DataFrame:
    known = labels.where("doc_id is not null and quality is not null")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    ).where("quality = 1")


def all_orders(counted: DataFrame) -> DataFrame:
    """(gram, n) of all orders from the counts of the highest, one row per gram.

    Below the highest order n tells what different symbols a gram follows, or, where only start
    marks can come before it, how often it occurs.
    """
    ends = F.array(*(F.substring("gram", ORDER + 1 - k, k) for k in range(1, ORDER + 1)))
    whole = counted.select(F.explode(ends).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("total"))
    # a gram is also one symbol before the gram that it ends in
    own = F.struct("gram", "total", F.lit(0).cast("long").alias("before"))
    tail = F.struct(F.substring("gram", 2, ORDER).alias("gram"), F.lit(0).cast("long").alias("total"), F.lit(1).cast("long").alias("before"))
    both = whole.select(F.inline(F.array(own, tail))).where("gram != ''")
    summed = both.groupBy("gram").agg(F.sum("total").alias("total"), F.sum("before").alias("before"))
    occurs = (F.length("gram") == ORDER) | F.col("gram").startswith(START)
    return summed.select("gram", F.when(occurs, F.col("total")).otherwise(F.col("before")).alias("n"))


def model(counted: DataFrame, shards: int) -> DataFrame:
    """Rows of MODEL from the counts (gram, n) of the highest order, one row per gram."""
    table = cut_lineage(all_orders(counted)).withColumn("k", F.length("gram"))
    of = lambda i: F.sum((F.col("n") == i).cast("long"))
    # one row per order
    rates = table.groupBy("k").agg(*(of(i).alias(f"n{i}") for i in (1, 2, 3, 4)), F.count(F.lit(1)).alias("types"))
    y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0))
    rates = rates.select(
        "k",
        *(
            F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), F.coalesce(
                i - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0)), F.lit(i / 2)
            ))).alias(f"d{i}") for i in (1, 2, 3)
        ),
        "types",
    )
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rated = table.join(F.broadcast(rates), "k").select(
        "gram", "n", "k", "types", discount.alias("discount"), F.expr("substring(gram, 1, k - 1)").alias("context")
    )
    contexts = rated.groupBy("context").agg(
        F.sum("n").alias("total"), F.sum("discount").alias("left"), F.max("types").alias("types")
    )
    share = F.col("left") / F.col("total")
    # below the first order lies the uniform distribution, one symbol more than seen
    share = F.when(F.col("context") == "", share / (F.col("types") + 1)).otherwise(share)
    none = F.lit(None).cast("double")
    likely_ends = rated.join(contexts.select("context", "total"), "context").select(
        "gram", ((F.col("n") - F.col("discount")) / F.col("total")).alias("a"), none.alias("g")
    )
    backoffs = contexts.select(F.col("context").alias("gram"), none.alias("a"), share.alias("g"))
    whole = likely_ends.unionByName(backoffs).groupBy("gram").agg(F.max("a").alias("a"), F.max("g").alias("g"))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = blocks.range_cuts(0, shards, shards)
        for batch in batches:
            n = pc.utf8_length(batch.column("gram")).to_numpy(zero_copy_only=False)
            a = pc.fill_null(batch.column("a"), 0.0).to_numpy(zero_copy_only=False)
            g = pc.fill_null(batch.column("g"), 1.0).to_numpy(zero_copy_only=False)
            a, g = coded(a).astype(np.int32), coded(g).astype(np.int32)
            for size in range(ORDER + 1):
                at = np.flatnonzero(n == size)
                text = "".join(batch.column("gram").take(pa.array(at)).to_pylist())
                points = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(at), size)
                hashed = keys(*points.T, size=len(at))
                shard = np.searchsorted(cuts, hashed, side="right")
                yield pa.record_batch(
                    [pa.array(shard), pa.array(hashed.view(np.int64)), pa.array(a[at]), pa.array(g[at])],
                    names=["shard", "key", "a", "g"],
                )

    return whole.mapInArrow(key, MODEL)


def perplexities(
    docs: DataFrame,
    labels: DataFrame,
    columns: tuple[str, ...] = ("lang",),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, `columns`, text if asked for among them, symbols, log_perplexity (null if no symbols)."""
    bounds = blocks.bounds_of(docs, block_bytes)
    fan, levels = blocks.tree(len(bounds) + 1)
    carried = tuple(c for c in columns if c not in ("doc_id", "text"))
    packed = blocks.packed(docs, bounds, carried)
    out = ["doc_id", *columns]
    kinds = dict(docs.dtypes) | {"doc_id": "long"}

    def count(key, rows, marks):
        if not rows.num_rows or not marks.num_rows:
            return pa.table({"gram": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        table = blocks.loaded(rows)
        teaches = pc.is_in(table["doc_id"], value_set=marks["doc_id"].combine_chunks())
        # only what teaches is read at all
        text = Text(W.whole(table["text"].filter(teaches)))
        return W.tidy(pa.table({"gram": pa.array(text.strings().tolist(), pa.string()), "n": pa.array(text.counts())}))

    def ask(table):
        return Text(W.whole(table["text"])).questions(), None

    def finish(block, table, said):
        text = Text(W.whole(table["text"]))
        size, total = text.log_probability(text.questions(), said)
        with np.errstate(divide="ignore", invalid="ignore"):
            rate = np.where(size > 0, -total / size, np.nan)
        made = {c: table[c] for c in out}
        made["symbols"] = pa.array(size)
        made["log_perplexity"] = pa.array(rate, mask=size == 0)
        return pa.table(made)

    marks = cut_lineage(trusted_marks(labels, bounds))
    lessons = blocks.packed(docs, bounds, wanted=likely(marks.select("doc_id")))
    counted = lessons.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(count, "gram string, n long")
    counted = cut_lineage(counted.groupBy("gram").agg(F.sum("n").alias("n")))
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in out) + ", symbols long, log_perplexity double"
    known = model(counted, fan**levels)
    return blocks.exchange(packed, len(bounds) + 1, ask, _RECORD, _looked_up, finish, schema, known=known)


def _looked_up(asked, extra, known) -> np.ndarray:
    """The model's record for each gram asked for, or that of an unseen one."""
    own = known["key"].to_numpy().view(np.uint64)
    order = np.argsort(own)
    own = own[order]
    record = np.empty(len(own) + 1, _RECORD)
    for name in ("a", "g"):
        record[name][:-1] = known[name].to_numpy()[order]
    record[-1] = (0, coded(np.ones(1))[0])
    at = np.searchsorted(own, asked)
    inside = at < len(own)
    at[inside] = np.where(own[at[inside]] == asked[inside], at[inside], len(own))
    return record[at]


def thresholds(scored: DataFrame, labels: DataFrame) -> tuple[DataFrame, float | None]:
    """(_lang, own): log perplexity up to which documents are accepted; and the limit of all others."""
    teachers = trusted(labels).where(held_out(F.col("doc_id"))).select("doc_id")
    known = scored.where("log_perplexity is not null").join(teachers, "doc_id")
    quantile = F.percentile_approx("log_perplexity", F.lit(QUANTILE), F.lit(10_000))
    overall = known.agg(quantile).first()[0]
    by = known.groupBy(F.col("lang").alias("_lang")).agg(quantile.alias("q"), F.count(F.lit(1)).alias("n"))
    few_of = F.greatest("q", F.lit(overall).cast("double")) + FEW_MARGIN
    own = F.when(F.col("n") >= ENOUGH, F.col("q") + MARGIN).otherwise(few_of)
    return by.select("_lang", own.alias("own")), None if overall is None else overall + FEW_MARGIN


def judged(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...] = ("lang",)) -> DataFrame:
    """Rows of `perplexities` with threshold and accepted; `lang` must be among the columns."""
    scored = cut_lineage(perplexities(docs, labels, columns))
    by, others = thresholds(scored.select("doc_id", "lang", "log_perplexity"), labels)
    low = F.col("log_perplexity") <= F.col("threshold")
    return (
        scored.join(few(by), F.col("lang").eqNullSafe(F.col("_lang")), "left")  # one row per language
        .withColumn("threshold", F.coalesce("own", F.lit(others).cast("double")))
        .withColumn("accepted", F.coalesce(low, F.lit(True)))
        .drop("_lang", "own")
    )
