"""Byte-level BPE in DuckDB, inside Spark tasks.

Each partition collects the distinct pieces of its texts (pieces never cross a space that a
non-space follows, so texts are split there first and the splits memoised). DuckDB holds the merge
table and one row per (piece, position, token); a recursive query joins neighbouring tokens with
the merge table and contracts the leftmost minimum-rank pair of each piece until none is left.
Pieces over ``LONG`` bytes (texts without spaces) go through a second form of that query, a bounded number of steps at a
time: a step contracts the leftmost minimum-rank pair and with it the pairs of the same rank to its right, up to and
including the first whose contraction makes a pair of lower rank. Contracting the leftmost again and again would take just
these, in this order, so the ids are the same; the steps are as many as different ranks and not as many as
bytes, and no step's rows outlive a call. Decoding joins id rows with the vocabulary and aggregates their bytes in order.

Nulls and edges: a null or empty text has no ids and decodes to no bytes; special tokens are
ordinary text; duplicates and extra columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import anti_clash, kept, slices

#: Positions fit 32 bits; a pair's rank and place order together as one integer.
_ENCODE = """
with recursive s(step, w, p, t, after, r) as (
    select 0, x.w, x.p, x.t, x.after, m.merged
    from (select w, p, t, lead(t) over right_of as n, lead(p) over right_of as after from start_rows window right_of as (partition by w order by p)) x
    left join merges m on m.pair = x.t::bigint * 65536 + x.n
    union all
    select y.step, y.w, y.p, y.t, y.after, m.merged
    from (
        select step, w, p, t, lead(t) over right_of as n, lead(p) over right_of as after
        from (
            select s.step + 1 as step, s.w as w, s.p as p, case when s.p = b.p then b.merged else s.t end as t
            from s join (
                select w, (min(r::bigint * 4294967296 + p) // 4294967296)::int as merged, (min(r::bigint * 4294967296 + p) % 4294967296)::int as p,
                       arg_min(after, r::bigint * 4294967296 + p) as gone
                from s where r is not null group by w) b using (w)
            where s.p <> b.gone)
        window right_of as (partition by w order by p)) y
    left join merges m on m.pair = y.t::bigint * 65536 + y.n
)
select w, p, t from s join (select w, max(step) as step from s group by w) using (w, step)
"""
#: The same for long pieces; {steps} bounds the recursion. ``r`` is the rank of the pair that starts here, ``run`` numbers
#: pairs of the least rank that follow each other without a gap (one token repeated: every other one is taken).
_ENCODE_LONG = """
with recursive s(step, w, p, t, n, r, last) as (
    select 0, x.w, x.p, x.t, x.n, m.merged, null::int
    from (select w, p, t, lead(t) over (partition by w order by p) as n from long_rows) x
    left join merges m on m.pair = x.t::bigint * 65536 + x.n
    union all
    select z.step, z.w, z.p, z.t, z.n, m.merged, null::int
    from (
        select step, w, p, t, lead(t) over (partition by w order by p) as n
        from (
            select step, w, p, case when taken then r else t end as t, coalesce(lag(taken) over (partition by w order by p), false) as gone
            from (
                select step, w, p, t, r, pick and p <= coalesce(min(case when pick and (least(l.merged, q.merged) < r or (l.merged is null and q.merged < r) or (q.merged is null and l.merged < r)) then p end) over (partition by w), 2147483647) as taken
                from (
                    select *, case when lag(pick, 2) over in_order then lag(r, 2) over in_order else lag(t) over in_order end as left_t
                    from (
                        select *, is_least and (row_number() over (partition by w, is_least, island order by p)) % 2 = 1 as pick
                        from (
                            select *, sum(case when is_least then 0 else 1 end) over (partition by w order by p) as island
                            from (
                                select s.step + 1 as step, w, p, t, n, r, lead(n) over (partition by w order by p) as n2, coalesce(r = min(r) over (partition by w), false) as is_least,
                                       min(r) over (partition by w) as least_rank
                                from s where s.step < {steps})
                            where least_rank is not null))
                    window in_order as (partition by w order by p)) y
                left join merges l on y.pick and l.pair = y.left_t::bigint * 65536 + y.r
                left join merges q on y.pick and q.pair = y.r::bigint * 65536 + y.n2))
        where not gone) z
    left join merges m on m.pair = z.t::bigint * 65536 + z.n
)
select w, p, t, r from s join (select w, max(step) as step from s group by w) using (w, step)
"""
#: Bytes from which a piece counts as long, and rows that the steps of one call may hold.
LONG, _STEP_ROWS = 96, 1_500_000

#: Ids as text, and the bytes that they decode to, from id rows (w, p, t).
_DECODE = "select w, encode(string_agg(i.t, ',' order by i.p)) as ids, unhex(string_agg(v.hex, '' order by i.p)) as bytes from id_rows i join vocab v on v.id = i.t group by w order by w"

_SPLIT_SLOW = re.compile(r" (?=\S)")
_IRREGULAR = re.compile(r" (?=\s)")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class DuckBpe:
    """One worker's encoder and decoder: a DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, ranks_path: str, pattern: str, generation: int = 220_000, piece_generation: int = 500_000, chunk: int = 20_000):
        import duckdb
        import regex

        self.ranks = read_ranks(ranks_path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.chunk, self.generation, self.piece_generation = chunk, generation, piece_generation
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left * 65536 + right)
                    merged.append(rank)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._give("t_merges", pair=pa.array(pairs, pa.int64()), merged=pa.array(merged, pa.int32()))
        self.db.execute("create table merges as select * from t_merges")
        self._give("t_vocab", id=pa.array(list(self.ranks.values()), pa.int32()), hex=pa.array([t.hex() for t in self.ranks]))
        self.db.execute("create table vocab as select * from t_vocab")
        # what is known of pieces and of units, each in two generations: the older one goes when the younger is full
        self.pieces: dict[str, tuple[bytes, bytes]] = {}
        self.old_pieces: dict[str, tuple[bytes, bytes]] = {}
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def _give(self, name: str, **columns: pa.Array) -> None:
        self.db.register(name, pa.table(columns))

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        """For each piece its ids (decimal, joined by commas) and the bytes that they decode to."""
        out: list[tuple[bytes, bytes]] = [(b"", b"")] * len(pieces)
        todo = sorted((i for i, p in enumerate(pieces) if p), key=lambda i: len(pieces[i]))
        ends = np.cumsum([len(pieces[i]) for i in todo])
        at = 0
        while at < len(todo):  # a call takes so many pieces, or so many bytes where pieces are long
            to = min(at + self.chunk, max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 20 * self.chunk))))
            part, at = todo[at:to], to
            w, pos, lens = self._rows([len(pieces[i]) for i in part])
            tokens = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)]
            whole = [k for k, i in enumerate(part) if pieces[i] in self.ranks]  # a piece that is a token needs no merges
            keep = np.asarray(lens <= LONG)
            keep[whole] = False
            long = ~keep
            long[whole] = False
            keep = np.repeat(keep, lens)
            self._give("start_rows", w=pa.array(w[keep]), p=pa.array(pos[keep]), t=pa.array(tokens[keep]))
            self._give("whole_rows", w=pa.array(whole, pa.int32()), p=pa.array(np.zeros(len(whole), np.int32)), t=pa.array([self.ranks[pieces[part[k]]] for k in whole], pa.int32()))
            self.db.execute("create or replace temp table id_rows as " + _ENCODE)
            self.db.execute("insert into id_rows select * from whole_rows")
            if long.any():
                long = np.repeat(long, lens)
                self._contract_long(pa.table({"w": w[long], "p": pos[long], "t": tokens[long]}))
            got = self.db.sql(_DECODE).to_arrow_table()
            for i, ids, text in zip(part, got["ids"].to_pylist(), got["bytes"].to_pylist(), strict=True):
                out[i] = (ids, text)
        return out

    def _contract_long(self, rows: pa.Table) -> None:
        """Adds the id rows of long pieces: bounded recursions, each from the rows of the pieces that the one before left open."""
        while rows.num_rows:
            self.db.register("long_rows", rows)
            steps = max(2, min(256, _STEP_ROWS // rows.num_rows))
            self.db.execute("create or replace temp table state as " + _ENCODE_LONG.format(steps=steps))
            self.db.execute("insert into id_rows select w, p, t from state where w not in (select w from state where r is not null)")
            rows = self.db.sql("select w, p, t from state where w in (select w from state where r is not null)").to_arrow_table()

    def decode_ids(self, sequences: list[list[int]]) -> list[bytes]:
        """The bytes of any id sequences."""
        out = [b""] * len(sequences)
        for lo in range(0, len(sequences), self.chunk):
            part = sequences[lo : lo + self.chunk]
            w, pos, lens = self._rows([len(s) for s in part])
            self._give("given_rows", w=pa.array(w), p=pa.array(pos), t=pa.array(np.fromiter((i for s in part for i in s), np.int32, int(lens.sum()))))
            self.db.execute("create or replace temp table id_rows as select * from given_rows")
            got = self.db.sql(_DECODE).to_arrow_table()
            for k, text in zip(got["w"].to_pylist(), got["bytes"].to_pylist(), strict=True):
                out[lo + k] = text
        return out

    @staticmethod
    def _rows(lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence number and position of every row of sequences of the given lengths."""
        lens = np.array(lengths, np.int64)
        w = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        pos = np.arange(len(w)) - np.repeat(np.cumsum(lens) - lens, lens)
        return w, pos.astype(np.int32), lens

    def _learn(self, units: list[str]) -> None:
        """Units are texts that follow a space, or, marked with two spaces in front, begin a text."""
        per = [self.pattern.findall(u[2:] if u.startswith("  ") else " " + u) for u in units]
        wanted = {p for ps in per for p in ps}
        if len(self.pieces) > self.piece_generation:
            self.pieces, self.old_pieces = {}, self.pieces
        for p in self.old_pieces.keys() & wanted.difference(self.pieces):
            self.pieces[p] = self.old_pieces[p]
        need = list(wanted.difference(self.pieces))
        self.pieces.update(zip(need, self.encode_pieces([p.encode() for p in need]), strict=True))
        known = self.pieces
        for unit, ps in zip(units, per, strict=True):
            if len(ps) == 1:
                self.young[unit] = known[ps[0]]
            else:
                got = [known[p] for p in ps]
                self.young[unit] = (b",".join([g[0] for g in got]), b"".join([g[1] for g in got]))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """For each text its ids (decimal, joined by commas) and the bytes that they decode to."""
        split = []
        for t in texts:
            units = (_SPLIT_SLOW.split(t) if _IRREGULAR.search(t) else t.split(" ")) if t else []
            # the first unit of a text has no space before it; no split leaves two spaces in front of a unit, so they mark it
            if units:
                units[0] = "  " + units[0]
            split.append(units)
        new = set().union(*split).difference(self.young)
        if len(self.young) > self.generation:
            self.old, self.young = self.young, {}
            new = set().union(*split)
        known = self.old.keys() & new
        for u in known:
            self.young[u] = self.old[u]
        fresh = list(new - known)
        if fresh:
            self._learn(fresh)
        get = self.young.__getitem__
        out = []
        for units in split:
            got = [get(u) for u in units]
            if got and not got[0][0]:
                got = got[1:]
            out.append((b",".join([g[0] for g in got]), b"".join([g[1] for g in got])))
        return out


def worker(ranks_path: str, pattern: str) -> DuckBpe:
    """The worker's connection and memo, kept between tasks."""
    return kept(("bpe", ranks_path, pattern), lambda: DuckBpe(ranks_path, pattern))


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: ids (as an array of ints) and the decoded bytes of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker(ranks_path, pattern)
        for batch in slices(batches, "text"):
            got = bpe.encode(batch.column(1).to_pylist())
            ids = [np.array(c.split(b","), np.int32) if c else np.zeros(0, np.int32) for c, _ in got]
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array([d for _, d in got], pa.binary())], ["doc_id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return anti_clash(docs, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: the number of ids and digests of the ids and of the decoded bytes, without sending the ids to the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker(ranks_path, pattern)
        for batch in slices(batches, "text"):
            got = bpe.encode(batch.column(1).to_pylist())
            n = [c.count(b",") + 1 if c else 0 for c, _ in got]
            ids = [hashlib.sha256(c).hexdigest() for c, _ in got]
            text = [hashlib.sha256(d).hexdigest() for _, d in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return anti_clash(docs, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
