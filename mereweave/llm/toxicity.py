"""Toxicity by a convolutional text classifier.

A text is lower-cased and cut into words (runs of letters and digits). A word's vector is the mean of hashed embeddings: of the word and of
its n-grams of bytes, so that inflected and unseen forms of a stem are near it. Filters of several widths run over the words, each filter's
largest value over the whole text is kept (max pooling), and a logistic layer makes them a score. Everything is trained here, in numpy.

Thresholds are calibrated by language: a quarter of the labelled rows is held back, and for each language the threshold of best F1 on it
becomes the score 0.5. The language of a text is told from its words alone, by frequencies learned from the labelled rows; a language with
too few positive rows takes the common threshold.

Every labelled row is used. ``start`` trains a first model on a bounded part of them; in each of ``rounds`` the rows are then dealt to
shards, each shard goes on from the common model through all its rows, both labels with equal weight in all, and the steps of the shards are
averaged number by number over those that changed it. The round with the least loss on the held back rows is kept. Languages are counted and
thresholds found over all rows as grouped sums; only the model, these sums and the rows of ``start`` reach the driver. Scoring covers whole
texts of all rows, in pieces of bounded size.

Nulls and edges: a null text is an empty one; a text without a word has all filters at zero and the
common threshold; labels that are null or neither 0 nor 1 are not learned, nor labels with a null or unknown id; several
labels of one id are all learned; with no row of one of the labels every score is the share of the other (0 or 1, or 0 without any row);
rows that repeat an id are scored each; other columns go nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _MULT, Cut, anti_clash, forget, mix64, slices, text_bytes, words

_GRAMS = (3, 4, 5, 6)
_PLAIN = np.full(256, 32, np.uint8)  # bytes of words stay; all others are spaces
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _PLAIN[_lo:_hi] = np.arange(_lo, _hi)


class Words:
    """Texts as numbers of their distinct words, with each word's hashed features."""

    def __init__(self, column: pa.Array, bits: int):
        data, offsets = text_bytes(pc.utf8_lower(column.fill_null("") if column.null_count else column))
        data = _PLAIN[data]
        starts, ends, h, self.first = words(data, offsets)
        self.hashes, at, self.of = np.unique(h, return_index=True, return_inverse=True)
        self.data, self.starts, self.ends, self.bits = data, starts[at], ends[at], bits
        self.lengths = np.diff(self.first)

    def features(self, lo: int, hi: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For words lo..hi, per kind of feature: buckets, ordered by word; words that have any; where each begins."""
        size = self.ends[lo:hi] - self.starts[lo:hi] + 2
        stop = np.cumsum(size)
        begin = stop - size
        total = int(stop[-1]) if len(stop) else 0
        word = np.repeat(np.arange(hi - lo), size)
        at = np.arange(total)
        source = np.clip(at - begin[word] - 1 + self.starts[lo:hi][word], 0, max(len(self.data) - 1, 0))
        text = np.full(total + 8, 0, np.uint8)
        text[:total] = self.data[source]
        text[begin], text[stop - 1] = 60, 62  # < and >: n-grams know where words begin and end
        eight = np.lib.stride_tricks.sliding_window_view(text, 8)
        shift = np.uint64(64 - self.bits)
        out = [((mix64(self.hashes[lo:hi] + _MULT) >> shift).astype(np.int64), np.arange(hi - lo), np.arange(hi - lo))]
        for n in _GRAMS:
            fits = np.flatnonzero(at + n <= stop[word])
            if len(fits):
                block = np.ascontiguousarray(eight[fits]).view("<u8").ravel() & ((np.uint64(1) << np.uint64(8 * n)) - np.uint64(1))
                owner = word[fits]
                new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                out.append(((mix64(block * _MULT + np.uint64(n)) >> shift).astype(np.int64), owner[new], new))
        return out

    def padded(self, pad: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of rows lo..hi, ``pad`` blanks (the number after the last word) behind each row; where the rows begin."""
        n = self.lengths[lo:hi]
        begin = np.cumsum(n + pad) - (n + pad)
        out = np.full(int((n + pad).sum()), len(self.hashes), np.int64)
        rows = np.repeat(np.arange(hi - lo), n)
        flat = self.of[self.first[lo] : self.first[hi]]
        out[np.arange(len(flat)) + pad * rows] = flat
        return out, begin


def vectors(features: list, table: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean embedding of each word's features, and their number."""
    out, count = np.zeros((n, table.shape[1]), np.float32), np.zeros(n, np.float32)
    for bucket, owner, new in features:
        out[owner] += np.add.reduceat(table[bucket], new, axis=0)
        count[owner] += np.diff(np.append(new, len(bucket)))
    return out / np.maximum(count, 1)[:, None], count


@dataclass
class Model:
    table: np.ndarray  # [bucket, dim]
    filters: list[np.ndarray]  # per width: [offset, dim, filter]
    bias: np.ndarray  # [filter], all widths
    out: np.ndarray  # [filter]
    base: float
    bits: int
    langs: list[str] = field(default_factory=list)
    tongue: np.ndarray | None = None  # log P(word bucket | language)
    threshold: np.ndarray | None = None  # by language, the common one last
    constant: float | None = None

    @property
    def pad(self) -> int:
        return len(self.filters) - 1


_TONGUE_BITS = 16


def _tongue_bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes ^ _MULT) >> np.uint64(64 - _TONGUE_BITS)).astype(np.int64)


def pooled(model: Model, w: Words, step: int = 16_384, block: int = 100_000) -> np.ndarray:
    """Largest value of every filter over each text, at least 0."""
    n = len(w.hashes)
    shape = [(k, f.shape[2]) for k, f in enumerate(model.filters, 1)]
    part = [[np.zeros((n + 1, width), np.float32) for _ in range(k)] for k, width in shape]  # what a word gives at each offset; the blank gives 0
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        v, _ = vectors(w.features(lo, hi), model.table, hi - lo)
        for k, f in enumerate(model.filters):
            for j in range(k + 1):
                part[k][j][lo:hi] = v @ f[j]
    rows = len(w.lengths)
    seq, begin = w.padded(model.pad, 0, rows)
    row = np.repeat(np.arange(rows), w.lengths + model.pad)
    best = np.full((rows, len(model.bias)), -np.inf, np.float32)
    for lo in range(0, len(seq), block):
        hi = min(len(seq), lo + block)
        here = seq[lo : min(len(seq), hi + model.pad)]
        here = np.concatenate([here, np.full(hi - lo + model.pad - len(here), n)])
        size, r = hi - lo, row[lo:hi]
        new = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        at = 0
        for k, (_, width) in enumerate(shape):
            total = part[k][0][here[:size]]
            for j in range(1, k + 1):
                total = total + part[k][j][here[j : j + size]]
            total[here[:size] == n] = -np.inf
            best[r[new], at : at + width] = np.maximum(best[r[new], at : at + width], np.maximum.reduceat(total, new, axis=0))
            at += width
    return np.maximum(best + model.bias, 0.0)


def languages(model: Model, w: Words) -> np.ndarray:
    """The number of each text's language; that after the last where there is none to tell."""
    rows = len(w.lengths)
    if not model.langs:
        return np.zeros(rows, np.int64)
    some = np.flatnonzero(w.lengths)
    out = np.full(rows, len(model.langs))
    if len(some):
        each = model.tongue[_tongue_bucket(w.hashes)]
        out[some] = np.stack([np.add.reduceat(each[:, k][w.of], w.first[:-1][some]) for k in range(len(model.langs))], axis=1).argmax(axis=1)
    return out


def scores(model: Model, column: pa.Array) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(column), model.constant)
    w = Words(column, model.bits)
    logit = pooled(model, w).astype(np.float64) @ model.out + model.base
    return 1 / (1 + np.exp(-np.clip(logit - model.threshold[languages(model, w)], -30, 30)))


# --- training ----------------------------------------------------------------------------------


class _Ada:
    """Steps scaled by the root of the summed squares of the gradient, dense or by row."""

    def __init__(self, value: np.ndarray, rate: float, total: np.ndarray | None = None):
        self.value, self.rate, self.sum = value, rate, np.full(value.shape, 1e-6, np.float32) if total is None else total

    def step(self, grad: np.ndarray, rows=slice(None)) -> None:
        self.sum[rows] += grad * grad
        self.value[rows] -= self.rate * grad / np.sqrt(self.sum[rows])


def _parts(model: Model, base: np.ndarray) -> list[np.ndarray]:
    return [model.table, *model.filters, model.bias, model.out, base]


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parts])


def _split(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    """Views of ``flat`` in the shapes of ``like``."""
    ends = np.cumsum([p.size for p in like])
    return [flat[e - p.size : e].reshape(p.shape) for e, p in zip(ends, like, strict=True)]


def _train(w: Words, label: np.ndarray, train: np.ndarray, check: np.ndarray, bits: int, dim: int, widths: int, filters: int, epochs: int, rate: float, batch: int) -> tuple[Model, np.ndarray]:
    """The model and the summed squares of all its numbers."""
    rng = np.random.default_rng(20)
    table = (rng.standard_normal((1 << bits, dim)) * 0.3).astype(np.float32)
    conv = [(rng.standard_normal((k, dim, filters)) * (1.0 / np.sqrt(k * dim))).astype(np.float32) for k in range(1, widths + 1)]
    out = (rng.standard_normal(widths * filters) * 0.1 + 0.2).astype(np.float32)
    model = Model(table, conv, np.zeros(widths * filters, np.float32), out, 0.0, bits)
    base = np.array([-1.0], np.float32)
    table_step, bias_step, out_step, base_step = _Ada(table, rate), _Ada(model.bias, rate), _Ada(model.out, rate), _Ada(base, rate)
    conv_step = [_Ada(f, rate) for f in conv]
    pos, neg = train[label[train] == 1], train[label[train] == 0]
    n = len(w.hashes)
    kept = [w.features(lo, min(n, lo + 65_536)) for lo in range(0, n, 65_536)]
    flat = _by_word(kept, n)
    best, best_loss, worse = None, np.inf, 0
    for _ in range(epochs):
        some = np.concatenate([pos, rng.permutation(neg)[: max(len(pos), 64)]])
        rng.shuffle(some)
        for lo in range(0, len(some), batch):
            rows = some[lo : lo + batch]
            _batch(rng, model, w, flat, rows, label[rows].astype(np.float32), base, table_step, conv_step, bias_step, out_step, base_step)
        model.base = float(base[0])
        loss = _loss(pooled_rows(model, w, flat, check) @ model.out + model.base, label[check])
        if loss < best_loss - 1e-4:
            best, best_loss, worse = (table.copy(), [f.copy() for f in conv], model.bias.copy(), model.out.copy(), model.base), loss, 0
        elif (worse := worse + 1) >= 2:
            break
    if best is not None:
        model.table, model.filters, model.bias, model.out, model.base = best
    return model, _joined([x.sum for x in (table_step, *conv_step, bias_step, out_step, base_step)])


def _loss(logit: np.ndarray, label: np.ndarray) -> float:
    """Log loss with both labels of equal weight."""
    each = np.logaddexp(0, np.where(label == 1, -logit, logit))
    return float(np.mean([each[label == k].mean() for k in (0, 1) if (label == k).any()])) if len(label) else 0.0


def _by_word(kept: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All features ordered by word, and where each word's begin."""
    owners, buckets, lo = [], [], 0
    for part in kept:
        for bucket, owner, new in part:
            owners.append(np.repeat(owner, np.diff(np.append(new, len(bucket)))) + lo)
            buckets.append(bucket.astype(np.int32))
        lo += 65_536
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    bucket = np.concatenate(buckets) if buckets else np.zeros(0, np.int32)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(n + 1))


def _take(flat: tuple[np.ndarray, np.ndarray], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the numbered words, one word after the other, and how many each has."""
    bucket, begin = flat
    count = begin[numbers + 1] - begin[numbers]
    ends = np.cumsum(count)
    return bucket[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[numbers] - (ends - count), count)], count


def _forward(model: Model, w: Words, flat: tuple, rows: np.ndarray, drop=None):
    n = w.lengths[rows]
    pad = model.pad
    spans = np.concatenate([w.of[w.first[r] : w.first[r + 1]] for r in rows]) if len(rows) else np.zeros(0, np.int64)
    own, of = np.unique(spans, return_inverse=True)
    bucket, count = _take(flat, own)
    v = np.zeros((len(own) + 1, model.table.shape[1]), np.float32)
    if len(own):
        v[:-1] = np.add.reduceat(model.table[bucket], np.cumsum(count) - count, axis=0) / count[:, None]
    if drop is not None:  # words that are left out of this step: what is found must not hang on a few of them
        of = np.where(drop.random(len(own))[of] < 0.4, len(own), of)
    row = np.repeat(np.arange(len(rows)), n)
    seq = np.full(int((n + pad).sum()) + pad, len(own))
    seq[np.arange(len(of)) + pad * row] = of
    begin = np.cumsum(n + pad) - (n + pad)
    size = len(seq) - pad
    values = []
    for k, f in enumerate(model.filters):
        total = (v @ f[0])[seq[:size]]
        for j in range(1, k + 1):
            total += (v @ f[j])[seq[j : j + size]]
        total[seq[:size] == len(own)] = -np.inf
        values.append(total)
    best = np.concatenate([np.maximum.reduceat(t, begin, axis=0) for t in values], axis=1)
    return own, bucket, count, v, seq, begin, n + pad, values, best


def pooled_rows(model: Model, w: Words, flat: tuple, rows: np.ndarray, batch: int = 64) -> np.ndarray:
    out = [np.maximum(_forward(model, w, flat, rows[lo : lo + batch])[-1] + model.bias, 0) for lo in range(0, len(rows), batch)]
    return np.concatenate(out) if out else np.zeros((0, len(model.bias)), np.float32)


def _batch(rng, model, w, flat, rows, label, base, table_step, conv_step, bias_step, out_step, base_step, weight=None) -> None:
    own, bucket, count, v, seq, begin, size, values, best = _forward(model, w, flat, rows, rng)
    raw = best + model.bias
    top = np.maximum(raw, 0)
    g = (1 / (1 + np.exp(-np.clip(top @ model.out + base[0], -30, 30))) - label) / len(rows)
    if weight is not None:
        g = g * weight
    back = np.where(raw > 0, g[:, None] * model.out[None, :], 0).astype(np.float32)  # [row, filter]
    dv = np.zeros_like(v)
    at = 0
    grads = []
    row = np.repeat(np.arange(len(rows)), size)
    for k, f in enumerate(model.filters):
        width = f.shape[2]
        own_best = best[:, at : at + width]
        r, c = np.nonzero(values[k] == own_best[row])
        key, first = np.unique(row[r] * width + c, return_index=True)  # the first place of the largest value
        live = np.isfinite(own_best.ravel()[key])
        place, rr, cc = r[first][live], key[live] // width, key[live] % width
        b = back[rr, at + cc]
        used = b != 0
        place, cc, b = place[used], cc[used], b[used]
        grad = np.zeros_like(f)
        for j in range(k + 1):
            word = seq[place + j]
            np.add.at(grad[j].T, cc, v[word] * b[:, None])
            np.add.at(dv, word, f[j].T[cc] * b[:, None])
        grads.append(grad)
        at += width
    out_step.step((top * g[:, None]).sum(axis=0).astype(np.float32))
    base_step.step(np.array([g.sum()], np.float32))
    bias_step.step(back.sum(axis=0))
    for s, grad in zip(conv_step, grads, strict=True):
        s.step(grad)
    hit = np.flatnonzero(dv[:-1].any(axis=1))
    if len(hit):
        ends = np.cumsum(count)
        pick = np.concatenate([np.arange(ends[h] - count[h], ends[h]) for h in hit])
        where, inverse = np.unique(bucket[pick], return_inverse=True)
        grad = np.zeros((len(where), v.shape[1]), np.float32)
        np.add.at(grad, inverse, np.repeat(dv[hit] / count[hit][:, None], count[hit], axis=0))
        table_step.step(grad, where)


def best_threshold(logit: np.ndarray, label: np.ndarray) -> float:
    """The threshold of the best F1: midway between the two logits around it."""
    z, of = np.unique(logit, return_inverse=True)
    return _best_cut(z, z, np.bincount(of, label == 1), np.bincount(of, label != 1))


def _best_cut(low: np.ndarray, high: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """The same over ascending bins of logits, with the least and the largest logit and the numbers of both labels in each."""
    low, high, hits, taken = low[::-1], high[::-1], np.cumsum(pos[::-1]), np.cumsum((pos + neg)[::-1])
    at = int((2 * hits / (taken + pos.sum())).argmax())
    return float(low[at] - 1.0) if at + 1 == len(low) else float((low[at] + high[at + 1]) / 2)


def _calibrate(model: Model, bins: pa.Table, least: int) -> None:
    """Thresholds from ``bins`` (lang, bin, pos, neg, low, high); that of all bins serves where a language has too few rows of a label."""
    lang, at, pos, neg, low, high = (bins[c].to_numpy() for c in ("lang", "bin", "pos", "neg", "low", "high"))

    def cut(rows: np.ndarray) -> float:
        at_, of = np.unique(at[rows], return_inverse=True)
        least_, most = np.full(len(at_), np.inf), np.full(len(at_), -np.inf)
        np.minimum.at(least_, of, low[rows])
        np.maximum.at(most, of, high[rows])
        return _best_cut(least_, most, np.bincount(of, pos[rows]), np.bincount(of, neg[rows]))

    model.threshold = np.full(len(model.langs) + 1, cut(np.arange(len(at))) if pos.sum() and neg.sum() else 0.0)
    for k in range(len(model.langs)):
        own = np.flatnonzero(lang == k)
        if min(pos[own].sum(), neg[own].sum()) >= least:
            model.threshold[k] = cut(own)


_CHUNK = 1 << 14  # numbers of the model that travel in a row
_BINS = 256  # bins of logits in a unit


def fit(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", label_col="toxic", per_class: int = 2500, most_bytes: int = 24 << 20, bits: int = 17, dim: int = 16, widths: int = 3, filters: int = 8,
    epochs: int = 12, rate: float = 0.05, batch: int = 32, least: int = 12, most_languages: int = 64, rounds: int = 2, shard_rows: int = 8192,
) -> Model:
    """Trains on all rows of ``docs`` that ``labels`` names. The classifier sees texts and labels; languages only group thresholds.

    ``per_class`` rows of each label and ``most_bytes`` of text bound the start alone.
    """
    cut = Cut(docs.sparkSession)
    own = anti_clash(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label in (0, 1)").distinct()
    named = own.count()
    shards = max(1, -(-named // shard_rows))
    every = anti_clash(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("h", F.xxhash64("text"))
    marks = cut.keep(every.select("doc_id", "h", "lang").join(own, "doc_id").groupBy("h", F.col("label").cast("int").alias("label")).agg(F.min("lang").alias("lang")))
    both = _likely(every.select("h", F.coalesce("text", F.lit("")).alias("text")), marks, "h", named).unionByName(marks, allowMissingColumns=True)
    both = both.withColumn("shard", F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    label = lambda k: F.struct(F.lit(k).alias("label"), F.max(F.col("label") == k).alias("held"), F.min(F.when(F.col("label") == k, F.col("lang"))).alias("lang"))
    rows = both.groupBy("shard", "h").agg(F.min("text").alias("text"), F.array(label(0), label(1)).alias("labels"))
    rows = rows.select("shard", "h", "text", F.explode(F.filter("labels", lambda x: x["held"])).alias("l")).select("shard", "h", "l.label", "text", "l.lang")
    rows = cut.keep(rows.sortWithinPartitions("shard", "h", "label"))
    cut.drop(marks)
    found = {(r.label, r.held): r for r in rows.groupBy("label", (F.col("h") % 4 == 0).alias("held")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()}
    number = {k: sum(r.n for (label, _), r in found.items() if label == k) for k in (0, 1)}
    if not number[0] or not number[1]:
        cut.drop(rows)
        return Model(np.zeros((1, 1)), [], np.zeros(0), np.zeros(0), 0.0, bits, constant=float(number[1] > 0))
    hold = len(found) == 4  # each label has rows to train on and rows to hold back
    bound = lambda k: min(1.0, per_class / number[k], most_bytes / sum(r.bytes for r in found.values()))
    share = F.when(F.col("label") == 1, bound(1)).otherwise(bound(0))
    got = rows.where(F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(1 << 30)) < share * (1 << 30)).orderBy("h", "label").select("text", "label", "h").toArrow()
    model, sums = start(got, bits, dim, widths, filters, epochs, rate, batch)
    _count_languages(rows, model, most_languages)
    weight = {k: sum(number.values()) / (2 * number[k]) for k in (0, 1)}
    best = None
    for k in range(rounds):
        model, sums, _ = _round(rows, model, sums, weight, hold, rate, batch, k)
        bins = _bins(rows, model, hold)
        if best is None or _mean_loss(bins) < _mean_loss(best[1]):
            best = model, bins
    model = best[0]
    _calibrate(model, best[1], least)
    cut.drop(rows)
    return model


def _likely(rows: DataFrame, own: DataFrame, key: str, n: int, most_log: int = 27) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among the ``n`` of ``own``, told by a bitmap of hashed keys: about 16 bits a key,
    16 MB at most. It loses no row of ``own``; what it lets pass besides is left to the join, to which the other texts need not travel. Keys of two types
    are not told apart."""
    kind = rows.schema[key].dataType.simpleString()
    if kind != own.schema[key].dataType.simpleString() or kind not in ("int", "bigint", "string"):
        return rows  # keys that a join calls equal may have other hashes
    log = min(most_log, max(15, (16 * n - 1).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(1 << log))
    bits = own.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    told = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("bucket"))
    return told.where(F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1).select(*rows.columns)


def start(got: pa.Table, bits: int, dim: int, widths: int, filters: int, epochs: int, rate: float, batch: int) -> tuple[Model, np.ndarray]:
    """A first model, trained on a table of text, label and h (a hash that deals the rows held back)."""
    label, h = got["label"].to_numpy(), got["h"].to_numpy()
    w = Words(got["text"].combine_chunks(), bits)
    held = h % 4 == 0
    if not all(((label == k) & held).any() and ((label == k) & ~held).any() for k in (0, 1)):
        held = np.zeros(len(label), bool)
    check = np.flatnonzero(held) if held.any() else np.arange(len(label))
    return _train(w, label, np.flatnonzero(~held), check, bits, dim, widths, filters, epochs, rate, batch)


def _round(rows: DataFrame, model: Model, sums: np.ndarray, weight: dict[int, float], hold: bool, rate: float, batch: int, number: int) -> tuple[Model, np.ndarray, int]:
    """The model after every shard has gone through its rows, the summed squares, and how many rows were learned."""
    base = np.array([model.base], np.float32)
    like = _parts(model, base)
    sent = rows.sparkSession.sparkContext.broadcast((model, _joined(like), sums))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model, values, sums = sent.value
        shapes = _parts(model, np.zeros(1, np.float32))
        shard, own, squares, steps, rng, done = None, None, None, None, None, 0

        def out() -> pa.RecordBatch:
            changes = np.stack([own - values, squares - sums])
            at = range(0, len(values), _CHUNK)
            numbers = [changes[:, lo : lo + _CHUNK].tobytes() for lo in at] + [np.array([done], np.int64).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([*range(len(at)), -1], pa.int32()), pa.array([shard] * len(numbers), pa.int32()), pa.array(numbers, pa.binary())], ["chunk", "shard", "numbers"])

        for part in slices(batches, "text", target=2 << 20):
            of = part.column("shard").to_numpy()
            for lo, hi in _runs(of):
                if of[lo] != shard:
                    if shard is not None:
                        yield out()
                    shard, own, squares, done = int(of[lo]), values.copy(), sums.copy(), 0
                    table, *conv, bias, last, base = views = _split(own, shapes)
                    local = Model(table, conv, bias, last, 0.0, model.bits)
                    steps = [_Ada(v, rate, q) for v, q in zip(views, _split(squares, shapes), strict=True)]
                    rng = np.random.default_rng([number, shard])
                some = part.slice(lo, hi - lo)
                label, h = some.column("label").to_numpy(), some.column("h").to_numpy()
                pick = rng.permutation(np.flatnonzero(h % 4 != 0) if hold else np.arange(len(h)))
                w = Words(some.column("text"), model.bits)
                flat = _by_word([w.features(at, min(len(w.hashes), at + 65_536)) for at in range(0, len(w.hashes), 65_536)], len(w.hashes))
                each = np.where(label == 1, weight[1], weight[0])
                for at in range(0, len(pick), batch):
                    here = pick[at : at + batch]
                    _batch(rng, local, w, flat, here, label[here].astype(np.float32), base, steps[0], steps[1:-3], *steps[-3:], weight=each[here])
                done += len(pick)
        if shard is not None:
            yield out()

    def mean(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("shard", "ascending"), ("numbers", "ascending")])
        if key[0].as_py() < 0:
            number = sum(int(np.frombuffer(x, np.int64)[0]) for x in table["numbers"].to_pylist()).to_bytes(8, "little")
            return pa.table({"chunk": pa.array([-1], pa.int32()), "numbers": pa.array([number], pa.binary())})
        total = count = None
        for x in table["numbers"].to_pylist():
            change = np.frombuffer(x, np.float32).reshape(2, -1)
            total, count = (change + total, (change[1] != 0) + count) if total is not None else (change, (change[1] != 0).astype(np.float32))
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "numbers": pa.array([(total / np.maximum(count, 1)).astype(np.float32).tobytes()], pa.binary())})

    changes = rows.select("shard", "h", "label", "text").mapInArrow(learn, "chunk int, shard int, numbers binary").groupBy("chunk").applyInArrow(mean, "chunk int, numbers binary").toArrow().sort_by("chunk")
    numbers = changes["numbers"].to_pylist()
    change = np.concatenate([np.frombuffer(x, np.float32).reshape(2, -1) for x in numbers[1:]], axis=1)
    sent.destroy()
    table, *conv, bias, out, base = _split(_joined(like) + change[0], like)
    return Model(table, conv, bias, out, float(base[0]), model.bits, model.langs, model.tongue), sums + change[1], int.from_bytes(numbers[0], "little")


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and end of each run of equal values."""
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
    return zip(at[:-1].tolist(), at[1:].tolist(), strict=True)


def _held(rows: DataFrame, hold: bool) -> DataFrame:
    return (rows.where("h % 4 = 0") if hold else rows).select("label", "text")


def _bins(rows: DataFrame, model: Model, hold: bool) -> pa.Table:
    """(lang, bin, pos, neg, low, high, loss_pos, loss_neg): the logits of the rows held back, counted in bins of a part of a unit."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = sent.value
        for batch in slices(batches, "text", target=2 << 20):
            w = Words(batch.column("text"), model.bits)
            z = pooled(model, w).astype(np.float64) @ model.out + model.base
            label = batch.column("label").to_numpy()
            loss = np.logaddexp(0, np.where(label == 1, -z, z))
            yield pa.RecordBatch.from_arrays([pa.array(languages(model, w), pa.int32()), pa.array(np.floor(z * _BINS).astype(np.int64)), batch.column("label"), pa.array(z), pa.array(loss)], ["lang", "bin", "label", "z", "loss"])

    each = _held(rows, hold).mapInArrow(run, "lang int, bin long, label int, z double, loss double")
    of = lambda k, value: F.sum(F.when(F.col("label") == k, value).otherwise(0))
    sums = each.groupBy("lang", "bin").agg(of(1, 1).alias("pos"), of(0, 1).alias("neg"), F.min("z").alias("low"), F.max("z").alias("high"), of(1, F.col("loss")).alias("loss_pos"), of(0, F.col("loss")).alias("loss_neg"))
    out = sums.orderBy("lang", "bin").toArrow()
    sent.destroy()
    return out


def _mean_loss(bins: pa.Table) -> float:
    """Log loss on the rows held back, both labels with equal weight."""
    pos, neg, loss_pos, loss_neg = (bins[c].to_numpy().sum() for c in ("pos", "neg", "loss_pos", "loss_neg"))
    return float(loss_pos / pos + loss_neg / neg) / 2


def _count_languages(rows: DataFrame, model: Model, most: int) -> None:
    """Sets the languages of most rows and the frequencies of their words, over all rows."""
    model.langs = sorted(r.lang for r in rows.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect())
    langs, bits = model.langs, model.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", target=2 << 20):
            w = Words(batch.column("text"), bits)
            number = pc.index_in(batch.column("lang"), pa.array(langs, pa.string())).to_numpy(zero_copy_only=False)
            key = np.repeat(number, w.lengths).astype(np.int64) << _TONGUE_BITS | _tongue_bucket(w.hashes)[w.of]
            key, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    seen = np.full((1 << _TONGUE_BITS, len(langs)), 0.05)
    if langs:
        got = rows.where(F.col("lang").isin(*langs)).select("lang", "text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        key = got["key"].to_numpy()
        seen[key & ((1 << _TONGUE_BITS) - 1), key >> _TONGUE_BITS] += got["n"].to_numpy()
    model.tongue = np.log(seen / seen.sum(axis=0, keepdims=True)).astype(np.float32)


def score(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, score, predicted) for every row, from its whole text alone."""
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits x dim numbers at most, and 2**16 a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", target=2 << 20):
            s = scores(sent.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
