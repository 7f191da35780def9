"""Chat formatting by quotation linking.

1. A message's lines are read with their quote level (leading ``>`` marks). Lines of level 0 are its own
   text; a run of lines of one level is a quoted passage; a line that announces a quote ("... wrote:") goes
   with it.
2. Passages of all levels and originals (a message's whole own text, and its parts between quotes) are hashed
   whole, by paragraph and by line, normalised (quote marks off, lower case, white space one space). A hash is
   joined to the latest earlier message of its conversation that has it; where there is none, to the first
   message of any other conversation (two rows per hash, so a passage that many share makes no pairs). A passage
   is linked by its largest parts that are found: as a whole, else by paragraphs, else by lines.
3. A message answers what the shallowest of its linked passages quote: the latest such message of its conversation,
   else the first one elsewhere; without links, the message before it.
   Threads and depths come from pointer doubling over these parents; a parent in a conversation of a larger id would
   allow loops, so there the thread goes on with the message before.
4. Conversations are built in reply order: a thread's messages, of all conversations, are numbered (``position``) so that every
   reply comes after what it answers; the thread's root is (thread_conv, thread_turn). Texts stand without quotes.

Orders within a conversation or thread are found over ranges of rows (``in_order``), so one that holds a third of all
messages is no task of its own; a passage's first holders are found in shares.

Nulls and edges: a null text is empty; messages with a null conv_id or turn quote and answer nothing and
are their own thread; rows that repeat (conv_id, turn) are returned as often as they come, the first own
text in order serves as their original; a message of quotes alone has an empty text; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Cut, anti_clash, slices

_MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
#: The closing words of a line that announces a quote.
_ANNOUNCES = re.compile(r"(?:wrote|writes|said|schrieb|schreibt|a écrit|écrit|escribió|escribe)\s*:\s*$", re.I)


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def fingerprint(text: str) -> int | None:
    """A signed 64-bit hash of normalised text; none for text without content."""
    plain = normalise(text)
    return xxhash.xxh3_64_intdigest(plain) - (1 << 63) if plain else None


def fragments(text: str) -> list[tuple[int, int]]:
    """(part, hash) of a text as a whole (0), of its paragraphs (1) and its lines (2); the largest part of equals."""
    parts = [(0, text), *((1, p) for p in re.split(r"\n\s*\n", text)), *((2, p) for p in text.split("\n"))]
    out: dict[int, int] = {}
    for n, p in parts:
        if (h := fingerprint(p)) is not None:
            out.setdefault(h, n)
    return [(n, h) for h, n in out.items()]


def parse(text: str | None) -> tuple[str, list[tuple[int, str]], list[str]]:
    """A message's own text, its quoted passages (level, text) in order, and its own parts between them."""
    own: list[str] = []
    starts = [0]
    passages: list[tuple[int, list[str]]] = []
    level_before = 0
    for line in (text or "").split("\n"):
        m = _MARKS.match(line)
        level = m.group(1).count(">") if m else 0
        if level:
            if level_before == 0:
                while own and not own[-1].strip():
                    own.pop()
                if own and _ANNOUNCES.search(own[-1]):
                    own.pop()
                starts.append(len(own))
            if level != level_before:
                passages.append((level, []))
            passages[-1][1].append(line[m.end() :])
        else:
            own.append(line)
        level_before = level
    parts = ["\n".join(own[i:j]) for i, j in zip(starts, [*starts[1:], len(own)], strict=True)]
    return "\n".join(own).strip("\n"), [(n, "\n".join(lines)) for n, lines in passages], parts


def _parsed(messages: DataFrame) -> DataFrame:
    kind = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("part", pa.int32()), ("hash", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, quoted, passed, originals, levels = [], [], [], [], []
            for text in batch.column(3).to_pylist():
                own, passages, parts = parse(text)
                texts.append(own)
                levels.append(max((n for n, _ in passages), default=0))
                found = [(n, fragments(p)) for n, p in passages]
                quoted.append([{"passage": i, "level": n, "part": k, "hash": h} for i, (n, hashes) in enumerate(x for x in found if x[1]) for k, h in hashes])
                passed.append(sum(bool(hashes) for _, hashes in found))
                originals.append(list(dict.fromkeys(h for p in (own, *parts) for _, h in fragments(p))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(texts, pa.string()), pa.array(levels, pa.int32()), pa.array(quoted, kind), pa.array(passed, pa.int32()), pa.array(originals, pa.list_(pa.int64()))], ["conv_id", "turn", "role", "own", "levels", "quoted", "n_quotes", "originals"])

    return messages.mapInArrow(run, "conv_id long, turn long, role string, own string, levels int, quoted array<struct<passage: int, level: int, part: int, hash: long>>, n_quotes int, originals array<long>")


def link_quotes(messages: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One row per message: conv_id, turn, role, text (without quotes), quote_levels, n_quotes,
    n_linked, parent_conv, parent_turn, thread_turn, depth, thread_conv, position."""
    cut = Cut(messages.sparkSession)
    own = anti_clash(messages, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    own = own.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    parsed = cut.keep(_parsed(own))
    named = parsed.where("conv_id is not null and turn is not null")
    passages = named.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.*")
    asked = cut.keep(passages.select("conv_id", "turn", "hash").distinct())
    wanted = asked.select("hash").distinct()
    said = cut.keep(named.select("conv_id", "turn", F.explode("originals").alias("hash")).join(wanted, "hash", "left_semi").distinct())
    # the latest earlier message of the same conversation with the passage: one ordered pass, no pairs
    both = said.select("conv_id", "hash", "turn", F.col("turn").alias("from_turn"), F.lit(1).alias("kind")).union(asked.select("conv_id", "hash", "turn", F.lit(None).cast("long"), F.lit(0)))
    seen = Window.partitionBy("conv_id", "hash").orderBy("turn", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = both.withColumn("from_turn", F.last("from_turn", ignorenulls=True).over(seen)).where("kind = 0").select("conv_id", "turn", "hash", "from_turn")
    holders = said.groupBy("hash", "conv_id").agg(F.min("turn").alias("turn")).withColumn("share", F.pmod(F.xxhash64("conv_id"), F.lit(64)))
    for of in (("hash", "share"), ("hash",)):  # the first two conversations of each share, then of all shares
        holders = holders.withColumn("n", F.row_number().over(Window.partitionBy(*of).orderBy("conv_id"))).where("n <= 2")
    holders = holders.select("hash", F.struct("conv_id", "turn").alias("first"))
    far = near.where("from_turn is null").join(holders, "hash").where("first.conv_id <> conv_id").groupBy("conv_id", "turn", "hash").agg(F.min("first").alias("first"))
    linked = near.join(far, ["conv_id", "turn", "hash"], "left").where("from_turn is not null or first is not null")
    # of a passage its largest parts that are found, of a message its shallowest linked passages
    by_part = passages.join(linked, ["conv_id", "turn", "hash"]).groupBy("conv_id", "turn", "passage", "level", "part").agg(F.max("from_turn").alias("near_turn"), F.min("first").alias("far"))
    by_passage = by_part.groupBy("conv_id", "turn", "passage", "level").agg(F.min_by(F.struct("near_turn", "far"), "part").alias("to"))
    by_level = by_passage.groupBy("conv_id", "turn", "level").agg(F.max("to.near_turn").alias("near_turn"), F.min("to.far").alias("far"), F.count("*").alias("n"))
    per = by_level.groupBy("conv_id", "turn").agg(F.min_by(F.struct("near_turn", "far"), "level").alias("to"), F.sum("n").alias("n_linked")).select("conv_id", "turn", "to.near_turn", "to.far", "n_linked")
    before = in_order(named.select("conv_id", "turn").distinct(), cut, ["conv_id"], ["turn"], "turn").drop("position")
    parents = cut.keep(before.join(per, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("near_turn", "previous").alias("parent_turn"), F.when(F.col("near_turn").isNull() & F.col("far").isNotNull(), F.col("far")).alias("far"), F.coalesce("n_linked", F.lit(0)).alias("n_linked")))
    threads = _threads(parents, cut)
    threads = in_order(threads, cut, ["thread_conv", "thread_turn"], ["conv_id", "turn"], "turn").drop("previous")
    info = parents.join(threads, ["conv_id", "turn"])
    out = parsed.join(info, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.col("levels").alias("quote_levels"), "n_quotes", F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.coalesce(F.col("far.conv_id"), F.when(F.col("parent_turn").isNotNull(), F.col("conv_id"))).alias("parent_conv"), F.coalesce(F.col("far.turn"), F.col("parent_turn")).alias("parent_turn"),
        F.coalesce("thread_turn", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("thread_conv", "conv_id").alias("thread_conv"),
        F.coalesce("position", F.lit(0)).alias("position"),
    )


def in_order(rows: DataFrame, cut: Cut, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``position`` (from 0, among the rows of equal keys) and ``previous`` (the ``value`` of the row before).

    Rows are dealt by ranges and numbered inside; a key that spans several ranges gets the counts and last values of those
    before. (keys, order) must be unique and hold no nulls.
    """
    dealt = cut.keep(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    here = Window.partitionBy("_range", *keys).orderBy(*order)
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_n"), F.max(F.struct(*order, F.col(value).alias("_value"))).alias("_last"))
    ends = ends.select(*keys, "_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"), F.last("_last._value").over(ahead).alias("_previous"))
    local = dealt.withColumn("_row", F.row_number().over(here) - 1).withColumn("_lag", F.lag(value).over(here))
    out = local.join(ends, [*keys, "_range"])
    return out.select(*rows.columns, (F.col("_row") + F.col("_before")).alias("position"), F.when(F.col("_row") == 0, F.col("_previous")).otherwise(F.col("_lag")).alias("previous"))


def _threads(parents: DataFrame, cut: Cut) -> DataFrame:
    """(conv_id, turn, thread_conv, thread_turn, depth): the root of each message and the steps to it, by pointer doubling.

    A row whose pointer has reached its root is done and is joined no more.
    """
    away = F.coalesce(F.col("far.conv_id") < F.col("conv_id"), F.lit(False))
    is_root = F.col("parent_turn").isNull() & ~away
    up = F.when(away, F.col("far.turn")).otherwise(F.coalesce("parent_turn", "turn"))
    state = cut.keep(parents.select("conv_id", "turn", F.when(away, F.col("far.conv_id")).otherwise(F.col("conv_id")).alias("up_conv"), up.alias("up"), F.when(is_root, 0).otherwise(1).cast("long").alias("depth"), is_root.alias("done")))
    while not state.where("not done").isEmpty():
        above = state.select(F.col("conv_id").alias("up_conv"), F.col("turn").alias("up"), F.col("up_conv").alias("next_conv"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("done").alias("ends"))
        moved = state.where("not done").join(above, ["up_conv", "up"]).select("conv_id", "turn", F.col("next_conv").alias("up_conv"), F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        new = cut.keep(state.where("done").unionByName(moved))
        cut.drop(state)
        state = new
    return state.select("conv_id", "turn", F.col("up_conv").alias("thread_conv"), F.col("up").alias("thread_turn"), "depth")
