r"""Language identification by segmentation-marginalised unigrams.

Every language has its own probabilities over the pieces of one fixed public vocabulary. A unit of
text (a run of letters, lower case, with the vocabulary's word-start mark) is scored by the forward
algorithm, which sums over all its segmentations into pieces; a text's score is the sum over its
units, and the prediction the language of the highest posterior under equal priors. The piece
probabilities are fitted by expectation maximisation: partitions run forward-backward over their
distinct units, Spark sums the expected counts, and only the model (pieces x languages) is gathered.

Training rows: ``fit`` takes about ``per_language`` distinct labelled texts of each language, chosen by a hash of
the text and without a cap on their length; a text that comes many times is one. That is a documented bound on the
fit; prediction covers every row. A model holds at most ``most_languages``; more labels raise ``ValueError``.

Letters are those of Unicode (``\p{L}``). Nulls and edges: a null text or one without a letter gives ``und`` and score 0;
labelled rows with a null language, a null text or no letter are not trained on; with no training row at all every
prediction is ``und``; units over 48 letters are learned and scored in pieces of 48.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import Cut, anti_clash, kept, slices

_LONGEST_UNIT = 48
_MARK = "▁"


class Pieces:
    """The fixed vocabulary: piece look-up by position and length over arrays of code points."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kept: dict[str, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            body = piece.removeprefix(_MARK)
            if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i)) and body.isalpha():
                kept.setdefault(piece.lower(), len(kept))
        self.size = len(kept) + 1  # the last one stands for a letter that is no piece
        self.unknown = len(kept)
        self.tables = []
        for n in range(1, max(map(len, kept)) + 1):
            items = sorted((self._key(np.array([[ord(c) for c in p]], np.uint64))[0], i) for p, i in kept.items() if len(p) == n)
            self.tables.append((np.array([k for k, _ in items], np.uint64), np.array([i for _, i in items], np.int64)))

    @staticmethod
    def _key(points: np.ndarray) -> np.ndarray:
        h = np.zeros(len(points), np.uint64)
        for c in range(points.shape[1]):
            h = (h + points[:, c] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def lattice(self, units: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
        """Unit lengths, and by end position the arcs (unit, start, end, piece) of all segmentations."""
        texts = [_MARK + u for u in units]
        lens = np.array([len(t) for t in texts])
        wide = int(lens.max())
        points = np.zeros((len(texts), wide + len(self.tables)), np.uint64)
        flat = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        row = np.repeat(np.arange(len(texts)), lens)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        points[row, col] = flat
        h = np.zeros(len(flat), np.uint64)
        arcs, lone, bare_row, bare_col = [], np.ones(len(flat), bool), row, col
        for n, (keys, ids) in enumerate(self.tables, 1):
            h = (h + points[row, col + n - 1] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (h >> np.uint64(29))
            if n > 1:  # only places with n letters left
                left = np.flatnonzero(col + n <= lens[row])
                row, col, h = row[left], col[left], h[left]
            if len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                if n == 1:
                    lone &= ~hit
                arcs.append((row[hit], col[hit], col[hit] + n, ids[at[hit]]))
        arcs.append((bare_row[lone], bare_col[lone], bare_col[lone] + 1, np.full(int(lone.sum()), self.unknown)))
        unit, start, end, piece = (np.concatenate([a[k] for a in arcs]) for k in range(4))
        order = np.lexsort((unit, end))
        unit, start, end, piece = unit[order], start[order], end[order], piece[order]
        cuts = np.searchsorted(end, np.arange(1, wide + 2))
        return lens, [(unit[a:b], start[a:b], end[a:b], piece[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def forward(lens: np.ndarray, arcs: list, prob: np.ndarray) -> np.ndarray:
    """alpha[unit, position, language]: the probability of each prefix, over all its segmentations."""
    alpha = np.zeros((len(lens), len(arcs) + 1, prob.shape[1]))
    alpha[:, 0] = 1.0
    for unit, start, end, piece in arcs:
        if len(unit):
            flow = alpha[unit, start] * prob[piece]
            first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            alpha[unit[first], end[0]] = np.add.reduceat(flow, first, axis=0)
    return alpha


def unit_scores(pieces: Pieces, prob: np.ndarray, units: list[str]) -> np.ndarray:
    """log P(unit | language) for each unit and language."""
    lens, arcs = pieces.lattice(units)
    alpha = forward(lens, arcs, prob)
    return np.log(np.maximum(alpha[np.arange(len(lens)), lens], 1e-300))


def expected_counts(pieces: Pieces, prob: np.ndarray, units: list[str], weight: np.ndarray) -> np.ndarray:
    """Expected piece counts [piece, language] of units that come ``weight[unit, language]`` times."""
    lens, arcs = pieces.lattice(units)
    alpha = forward(lens, arcs, prob)
    beta = np.zeros_like(alpha)
    beta[np.arange(len(lens)), lens] = 1.0
    total = np.maximum(alpha[np.arange(len(lens)), lens], 1e-300)
    out = np.zeros_like(prob)
    for unit, start, end, piece in reversed(arcs):
        if len(unit):
            back = prob[piece] * beta[unit, end]
            np.add.at(out, piece, alpha[unit, start] * back * (weight / total)[unit])
            np.add.at(beta, (unit, start), back)
    return out


@lru_cache(1)
def _letters():
    import regex

    return regex.compile(r"\p{L}+")


def units_of(text: str) -> list[str]:
    out = _letters().findall(text.lower())
    if any(len(u) > _LONGEST_UNIT for u in out):
        out = [u[i : i + _LONGEST_UNIT] for u in out for i in range(0, len(u), _LONGEST_UNIT)]
    return out


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


class Model:
    """Languages, and P(piece | language)."""

    def __init__(self, vocab_path: str, langs: list[str], prob: np.ndarray):
        self.vocab_path, self.langs, self.prob = vocab_path, langs, prob


def fit(labelled: DataFrame, vocab_path: str, text_col="text", lang_col="lang", per_language: int = 3000, rounds: int = 3, most_languages: int = 1000) -> Model:
    """Fits the piece probabilities of every language that ``labelled`` names."""
    rows = anti_clash(labelled, text=text_col, lang=lang_col).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("text"))
    found = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).limit(most_languages + 1).collect()
    if len(found) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    counts = {r["lang"]: r["n"] for r in found}
    langs = sorted(counts)
    if not langs:
        return Model(vocab_path, [], np.zeros((pieces_of(vocab_path).size, 0)))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_language / counts[k])))])[F.col("lang")]
    sample = rows.where(F.pmod(F.col("h"), F.lit(1 << 30)) < share * F.lit(1 << 30)).groupBy("lang", "h").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            seen: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.update((u, lang) for u in units_of(text))
            units, names = zip(*seen, strict=True) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(names, pa.string()), pa.array(seen.values(), pa.int64())], ["unit", "lang", "n"])

    units = sample.select("lang", "text").mapInArrow(count, "unit string, lang string, n long").groupBy("unit", "lang").agg(F.sum("n").alias("n"))
    size = pieces_of(vocab_path).size
    prob = np.full((size, len(langs)), 1.0 / size)
    number = {k: i for i, k in enumerate(langs)}
    spark = labelled.sparkSession
    units = Cut(spark).keep(units.repartition("unit"))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(prob)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            pieces, total = pieces_of(vocab_path), np.zeros((size, len(langs)))
            for batch in batches:
                for lo in range(0, batch.num_rows, 4000):
                    part = batch.slice(lo, 4000).to_pydict()
                    weight = np.zeros((len(part["unit"]), len(langs)))
                    weight[np.arange(len(weight)), [number[k] for k in part["lang"]]] = part["n"]
                    total += expected_counts(pieces, sent.value, part["unit"], weight)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang], pa.float64())], ["piece", "lang", "n"])

        sums = units.select("unit", "lang", "n").mapInArrow(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        counted = np.full((size, len(langs)), 0.01)
        for r in sums.toLocalIterator():  # bounded by pieces x languages
            counted[r["piece"], r["lang"]] += r["n"]
        prob = counted / counted.sum(axis=0)
        sent.unpersist()
    return Model(vocab_path, langs, prob)


class _Scorer:
    """Scores texts in a worker, memoising what lies between spaces (bounded: dropped when full)."""

    def __init__(self, model: Model, most: int = 400_000):
        self.model, self.most = model, most
        self.pieces = pieces_of(model.vocab_path)
        self.place: dict[str, int] = {}
        self.score = np.zeros((0, len(model.langs)))
        self.letters = np.zeros(0, bool)

    def _learn(self, new: list[str]) -> None:
        per = [units_of(w) for w in new]
        distinct = list({u for us in per for u in us})
        at = {u: i for i, u in enumerate(distinct)}
        got = [unit_scores(self.pieces, self.model.prob, distinct[i : i + 4000]) for i in range(0, len(distinct), 4000)]
        table = np.concatenate(got) if got else np.zeros((0, len(self.model.langs)))
        flat = np.array([at[u] for us in per for u in us], np.int64)
        owner = np.repeat(np.arange(len(new)), [len(us) for us in per])
        score = np.zeros((len(new), len(self.model.langs)))
        np.add.at(score, owner, table[flat])
        self.place.update(zip(new, range(len(self.score), len(self.score) + len(new)), strict=True))
        self.score = np.concatenate([self.score, score])
        self.letters = np.concatenate([self.letters, [bool(us) for us in per]])

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        seen = set().union(*split)
        if len(self.place) + len(seen) > self.most:
            self.place, self.score, self.letters = {}, self.score[:0], self.letters[:0]
        new = list(seen.difference(self.place))
        if new:
            self._learn(new)
        get = self.place.__getitem__
        out, any_letter = np.zeros((len(texts), len(self.model.langs))), np.zeros(len(texts), bool)
        for k, units in enumerate(split):
            at = np.fromiter(map(get, units), np.int64, len(units))
            out[k] = self.score[at].sum(axis=0)
            any_letter[k] = self.letters[at].any()
        return out, any_letter


def predict(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """``lang_pred`` and ``score`` (the prediction's posterior) for the id of every row; nothing but the text is used."""
    return annotate(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), model).select("doc_id", "lang_pred", "score")


def annotate(docs: DataFrame, model: Model, text_col="text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row; its other columns pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    langs, key, at = model.langs, uuid.uuid4().hex, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(("langid", key), lambda: _Scorer(sent.value))
        for batch in slices(batches, text_col):
            texts = batch.column(at).to_pylist()
            if langs:
                logp, some = scorer(texts)
                best = logp.argmax(axis=1)
                score = 1.0 / np.exp(logp - logp.max(axis=1, keepdims=True)).sum(axis=1)
                pred = [langs[b] if s else "und" for b, s in zip(best, some, strict=True)]
                score = np.where(some, score, 0.0)
            else:
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)
