"""Conversation repair: the cheapest edits that make the turns alternate.

The roles of a conversation, by their initials, have to be one optional ``s``
and then pairs of ``u`` and ``a``, or nothing.  A row is kept, given the role
user or assistant, or deleted; rows with an empty text may be inserted.

Rows are numbered by a distributed sort.  A segment is 64 consecutive rows of a
conversation; segments are hash-partitioned into batches of bounded size, and in
each batch a recursive query of DuckDB advances one row a recursion in all
segments at once, keeping the least cost, and among those the least audit, for
each pair of grammar states before and after.  The segments of a long
conversation are then rows of the same recursion, 64 at a time, until one is
left, so no task holds more than a batch, however long a conversation is.

Order is by turn (nulls first), then by role and by the SHA-256 of the text.
Null roles and texts are one space, and so are nulls in the hashed key of the
damage; a null conversation id is a conversation of its own.  The first fault of
a row counts: blank (no visible character), duplicate (role and text were
there before in the conversation), truncated (the last visible character ends no
sentence).  A conversation without rows has zeros, an empty audit and the hash
of the empty string; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm.store import cut, shared_folder, ship
from graphloom.operators.ordered import ranked

#: Rows, or segments, that one recursion walks through.
SEGMENT = 64
#: Rows of a batch, on average.
BATCH_ROWS = 4096
#: Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Grammar states: 0 nothing yet, 1 after ``s``, 2 after ``u``, 3 after ``a``.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Insertions between states that do not come back to where they began.
INSERTED = {0: {2: "I", 3: "II"}, 1: {2: "I", 3: "II"}, 2: {3: "I"}, 3: {2: "I"}}
#: What has to be inserted after the last row.
CLOSING = {0: "", 1: "II", 2: "I", 3: ""}
_BLANK = "[^\\x20\\x09-\\x0D]"


@cache
def steps() -> dict[tuple[str, bool, bool, int, int], tuple[int, str]]:
    """Least cost and audit of a row (its initial, whether it must go, whether it
    is truncated) from one state to another, insertions before it included."""
    best = {}
    for x in "sua-":
        for must in (False, True):
            for cut_off in (False, True):
                for p in range(4):
                    for m, audit in {p: "", **INSERTED[p]}.items():
                        ways = [(m, DELETE, "D")]
                        if not must:
                            ways.append((3 if m == 2 else 2, RENAME + TRUNCATED * cut_off, "R"))
                            if (m, x) in NEXT:
                                ways.append((NEXT[m, x], TRUNCATED * cut_off, "K"))
                        for q, cost, letter in ways:
                            key, way = (x, must, cut_off, p, q), (cost + INSERT * len(audit), audit + letter)
                            best[key] = min(best.get(key, way), way)
    return best


_RECURSION = """
WITH RECURSIVE ends AS (SELECT c, seg, max(i) + 1 AS n FROM moves GROUP BY c, seg),
walk AS (
  SELECT c, seg, 0::BIGINT AS i, p, p AS q, 0::BIGINT AS cost, '' AS audit, '' AS path FROM ends, range(4) AS s(p) WHERE seg > 0 OR p = 0
  UNION ALL
  SELECT c, seg, i, p, q, best.cost, best.audit, best.path FROM (
    SELECT w.c, w.seg, w.i + 1 AS i, w.p, m.q, min({'cost': w.cost + m.cost, 'audit': w.audit || m.audit, 'path': w.path || m.path}) AS best
    FROM walk w JOIN moves m ON m.c = w.c AND m.seg = w.seg AND m.i = w.i AND m.p = w.q GROUP BY ALL))
SELECT c, seg, p, q, cost, audit, path FROM walk JOIN ends USING (c, seg) WHERE i = n
"""
_FIRST = "CREATE OR REPLACE TEMP TABLE moves AS SELECT c, pos // {n} AS seg, pos % {n} AS i, p, q, cost, audit, q::VARCHAR AS path FROM batch JOIN step USING (x, must, cut_off)"
_LATER = "CREATE OR REPLACE TEMP TABLE moves AS SELECT c, seg // {n} AS seg, seg % {n} AS i, p, q, cost, audit, path FROM batch"
_MOVES = "c bigint, seg bigint, p bigint, q bigint, cost bigint, audit string, path string"
_DUCK: list = []


def _duck():
    """This worker's connection, with the table of steps."""
    if not _DUCK:
        import duckdb

        c = duckdb.connect(config={"threads": 1, "memory_limit": "1GB"})
        c.execute("CREATE TABLE step (x VARCHAR, must BOOLEAN, cut_off BOOLEAN, p BIGINT, q BIGINT, cost BIGINT, audit VARCHAR)")
        c.executemany("INSERT INTO step VALUES (?, ?, ?, ?, ?, ?, ?)", [(*k, *v) for k, v in steps().items()])
        _DUCK.append(c)
    return _DUCK[0]


def solved(rows: DataFrame, first: bool, batches: int, segment: int = SEGMENT) -> DataFrame:
    """``c, seg, p, q, cost, audit, path`` of each segment of ``rows``: single rows
    if ``first``, else the segments of the level before."""
    load = (_FIRST if first else _LATER).format(n=segment)
    place = F.expr(f"{'pos' if first else 'seg'} div {segment}")

    def run(_, group):
        c = _duck()
        c.register("batch", group)
        c.execute(load)
        c.unregister("batch")
        return c.execute(_RECURSION).to_arrow_table()

    return rows.withColumn("_batch", F.pmod(F.xxhash64("c", place), F.lit(batches))).groupBy("_batch").applyInArrow(lambda k, t: run(k, t.drop_columns(["_batch"])), _MOVES)


# -- rows ---------------------------------------------------------------------------


def rows_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copy`` with spaces for nulls."""
    space = F.lit(" ")
    return conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"), F.lit(0).alias("copy"))


def damaged(rows: DataFrame) -> DataFrame:
    """One row in five spoiled, by the hash of conversation and turn."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv", ":", "turn")))
    kind = rows.withColumn("_kind", F.crc32(key.cast("binary")) % 20).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return kind.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


class Repair:
    """The tables of a repair: ``conversations`` (``conv, c, n, gaps`` and the
    counts of faults), ``best`` (``c, cost, audit, path``) and ``rows``."""

    def __init__(self, rows: DataFrame, segment: int = SEGMENT, batch_rows: int = BATCH_ROWS):
        spark = rows.sparkSession
        ship(spark)
        folder = shared_folder(spark)
        self.segment = segment
        order = (F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "copy")
        self.texts = cut(ranked(rows.withColumn("digest", F.sha2("text", 256)), lambda df, name: cut(df, name, folder), *order), "ordered", folder)
        narrow = self.texts.select("conv", "turn", "rank", "role", "digest", (~F.col("text").rlike(_BLANK)).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"))
        narrow = narrow.select("*", F.substring("role", 1, 1).alias("initial"))
        turns = narrow.groupBy("conv", "turn").agg(F.min("rank").alias("rank"), F.count("*").alias("n"))
        gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint")
        convs = cut(turns.groupBy("conv").agg(F.min("rank").alias("c"), F.sum("n").alias("n"), gaps.alias("gaps")), "conversations", folder)
        placed = narrow.join(convs.withColumnRenamed("conv", "_conv"), _same(F.col("conv"), F.col("_conv"))).withColumn("pos", F.col("rank") - F.col("c"))
        seen = placed.groupBy("c", "role", "digest").agg(F.min("rank").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
        again = placed.join(seen, ["c", "role", "digest"], "left")
        blank = F.col("blank")
        twice = ~blank & F.coalesce(F.col("rank") > F.col("_first"), F.lit(False))
        rows = again.select("c", "n", "pos", "rank", "initial", blank.alias("blank"), twice.alias("twice"), (~blank & ~twice & F.col("open")).alias("cut_off"))
        rows = rows.withColumn("must", F.col("blank") | F.col("twice")).withColumn("x", F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-"))
        self.rows = cut(rows, "rows", folder)

        seg = F.expr(f"pos div {segment}")
        next_seg = F.when((F.col("pos") + 1) % segment == 0, F.array(seg, seg + 1)).otherwise(F.array(seg))  # the last of a segment is seen by the next
        ghosts = self.rows.select("c", "pos", "initial", "blank", "twice", "cut_off", seg.alias("own"), F.explode(next_seg).alias("seg"))
        before = F.lag("initial").over(W.partitionBy("c", "seg").orderBy("pos"))
        pairs = ghosts.withColumn("_pair", F.concat(before, "initial")).where("own = seg")
        count = lambda x: F.coalesce(F.sum(x.cast("bigint")), F.lit(0)).cast("bigint")
        faults = pairs.groupBy("c").agg(count(F.col("blank")).alias("blank"), count(F.col("twice")).alias("duplicate"), count(F.col("cut_off")).alias("truncated"), count(~F.col("_pair").isin("su", "ua", "au")).alias("illegal"))
        self.conversations = convs.join(faults, "c")

        size = convs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
        batches = lambda n: max(1, -(-n // batch_rows))
        level = solved(self.rows.select("c", "pos", "x", "must", "cut_off"), True, batches(size["rows"]), segment)
        whole, length = [], segment
        while length < size["most"]:
            level = cut(level, f"level{length}", folder).join(convs.select("c", "n"), "c")
            whole.append(level.where(F.col("n") <= length).drop("n"))
            level = solved(level.where(F.col("n") > length).drop("n"), False, batches(16 * size["rows"] // length), segment)
            length *= segment
        for part in whole:
            level = level.unionByName(part)
        closing = F.element_at(F.create_map(*(F.lit(x) for kv in CLOSING.items() for x in kv)), F.col("q").cast("int"))
        way = F.min(F.struct((F.col("cost") + INSERT * F.length(closing)).cast("bigint").alias("cost"), F.concat("audit", closing).alias("audit"), "path"))
        self.best = cut(level.where("p = 0").groupBy("c").agg(way.alias("w")).select("c", "w.*"), "best", folder)

    def repaired(self) -> DataFrame:
        """``c, pos, k, role, text``: what the conversations become, ordered by ``pos, k``."""
        n = self.segment
        states = F.concat(F.lit("0"), "path").cast("binary")
        segs = self.best.select("c", states.alias("states"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(length(path) - 1) div {n}"))).alias("seg"))
        segs = segs.select("c", "seg", F.substring("states", (F.col("seg") * n + 1).cast("int"), F.lit(n + 1)).cast("string").alias("states"))
        at = (F.col("pos") % n).cast("int")
        rows = self.rows.withColumn("seg", F.expr(f"pos div {n}")).join(segs, ["c", "seg"])
        rows = rows.withColumn("p", F.substring("states", at + 1, F.lit(1))).withColumn("q", F.substring("states", at + 2, F.lit(1)))
        known = F.create_map(*(F.lit(x) for (x, must, off, p, q), (_, audit) in steps().items() for x in (f"{x}{must}{off}{p}{q}".lower(), audit)))
        audit = F.element_at(known, F.concat("x", F.col("must").cast("string"), F.col("cut_off").cast("string"), "p", "q"))
        rows = rows.select("c", "pos", "rank", "p", "q", audit.alias("audit")).join(self.texts.select("rank", "role", "text"), "rank")
        line = lambda role, text: F.array(F.struct(role.alias("role"), text.alias("text")))
        none = F.array().cast("array<struct<role:string,text:string>>")
        user, assistant = (line(F.lit(r), F.lit("")) for r in ("user", "assistant"))
        put = F.when(F.col("audit").startswith("II"), F.concat(user, assistant)).when(F.col("audit").startswith("I"), F.when(F.col("p") == "2", assistant).otherwise(user)).otherwise(none)
        own = F.when(F.col("audit").endswith("K"), line(F.col("role"), F.col("text"))).when(F.col("audit").endswith("R"), line(F.when(F.col("q") == "2", "user").otherwise("assistant"), F.col("text"))).otherwise(none)
        inside = rows.select("c", "pos", F.concat(put, own).alias("lines"))
        last = F.substring("path", -1, 1)
        end = F.when(last == "1", F.concat(user, assistant)).when(last == "2", assistant).otherwise(none)
        both = inside.unionByName(self.best.select("c", F.length("path").cast("bigint").alias("pos"), end.alias("lines")))
        return both.select("c", "pos", F.posexplode("lines").alias("k", "line")).select("c", "pos", "k", "line.*")


def _hashes(lines: DataFrame) -> DataFrame:
    """``c, repaired_sha256`` of ``role:text`` lines, fed to the hash as they come in order."""

    def run(batches):
        current, running = None, None
        for batch in batches:
            done_c, done_h = [], []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if c != current:
                    if running is not None:
                        done_c.append(current)
                        done_h.append(running.hexdigest())
                    current, running = c, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(done_c, pa.int64()), pa.array(done_h, pa.string())], names=["c", "repaired_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([running.hexdigest()])], names=["c", "repaired_sha256"])

    return lines.repartition("c").sortWithinPartitions("c", "pos", "k").select("c", "role", "text").mapInArrow(run, "c bigint, repaired_sha256 string")


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, k, role, text``: the repaired conversations; those that end up empty have no rows."""
    done = Repair(rows_of(conversations, conv, turn, role, text))
    return done.repaired().join(done.conversations.select("c", F.col("conv").alias(conv)), "c").select(conv, "pos", "k", "role", "text")


def digests(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = True) -> DataFrame:
    """Per conversation id of the table: gaps, faults, cost and audit of the
    cheapest repair, and the hash of the repaired lines."""
    rows = rows_of(conversations, conv, turn, role, text)
    done = Repair(damaged(rows) if damage else rows)
    ids = rows.select(F.col("conv").alias("_id")).distinct()
    found = done.conversations.join(done.best.select("c", "cost", "audit"), "c").join(_hashes(done.repaired()), "c", "left")
    all_ids = ids.join(found, _same(F.col("_id"), F.col("conv")), "left")
    numbers = [F.coalesce(x, F.lit(0)).cast("bigint").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_ids.select(F.col("_id").alias(conv), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
