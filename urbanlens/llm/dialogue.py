"""Conversation structure repair by a rank-convergence parallel Viterbi pass.

Rows of a conversation, in order of turn, are kept (cost 0), given the role user or
assistant (1), deleted (2; required for blank and repeated rows) or get empty rows of
either role inserted before them (5 each), so that the role initials become
``(s?(ua)+)?``; truncated rows that stay add 5. Of the cheapest repairs the one whose
edits (K, R, D, I in order) are ASCII-least is made.

1. Rows are dealt out by ranges of (conv_id, turn, role, digest), so a conversation of any
   size spreads over tasks, and cut into chunks of ``CHUNK_ROWS`` rows or ``CHUNK_BYTES``.
   Rows to be deleted for sure are runs: they hold a count, no text.
2. Costs to the end from each of four states ("nothing yet", "after s", "after u",
   "after a") run backwards through every chunk at once, from a speculative vector, that of
   the end of a conversation. A step is a min-plus product, so two vectors that differ by a
   constant stay that way. A chunk whose right neighbour's vector differs by more
   than a constant from the one it used is run again, until none is left. Chunks of
   runs alone shift all costs alike and are passed over.
3. The stitched vectors give the edits forwards. The state in which a chunk is
   entered comes from composing the chunks' state maps, twice as many at a time.

Conversations inside one chunk, nearly all, need neither fix-up passes nor a shuffle after
the first two.

Edge cases: NULL conv_ids are one conversation, NULL turns come first, a NULL role or text is one
space, rows of one turn are ordered by role and SHA-256 of role and text; rows
that repeat role and text of an earlier row are duplicates; a conversation without rows has no
pieces; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from urbanlens.llm.common import materialize, read

CHUNK_ROWS = 4096
CHUNK_BYTES = 1 << 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A row's code is the class of its
# initial (0 s, 1 u, 2 a, 3 other), with 4 added if it is truncated; 8 is a run of deletions.
STATES = range(4)
NEXT = (2, 2, 3, 2)  # by a row of the only role out of user and assistant that may follow
KEEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # by (state, class)
RUN = 8
END = (0, 2 * INSERT, INSERT, 0)  # costs at the end of a conversation
NAMES = {2: "user", 3: "assistant"}


def step(code: int, n: int, right: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row from the costs after it."""
    if code == RUN:
        return tuple(x + DELETE * n for x in right)
    extra, kind = (TRUNCATED if code & 4 else 0), code & 3
    own = []
    for q in STATES:
        best = min(right[q] + DELETE, right[NEXT[q]] + REROLE + extra)
        if (q, kind) in KEEP:
            best = min(best, right[KEEP[q, kind]] + extra)
        own.append(best)
    u, a = min(own[2], own[3] + INSERT), min(own[3], own[2] + INSERT)
    return min(own[0], u + INSERT), min(own[1], u + INSERT), u, a


def vectors(codes: bytes, runs: list[int], right: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs before each row of a chunk, and after the last."""
    out = [tuple(right)]
    for code, n in zip(reversed(codes), reversed(runs), strict=True):
        out.append(step(code, n, out[-1]))
    return out[::-1]


def normal(vector: tuple[int, ...]) -> tuple[int, ...]:
    least = min(vector)
    return tuple(x - least for x in vector)


def trace(codes: bytes, runs: list[int], costs: list[tuple[int, ...]], q: int, finish: bool) -> tuple[list[tuple[str, int, int]], int]:
    """Least edits of a chunk entered in state ``q``, as (edit, row or -1, new state) with
    a run's row standing for all of it, and the state left. ``finish``: the conversation ends here."""
    out, i = [], 0
    while i < len(codes):
        code, now, after = codes[i], costs[i][q], costs[i + 1]
        if code == RUN or now == after[q] + DELETE:
            out.append(("D", i, q))
            i += 1
            continue
        to = NEXT[q]
        if now == costs[i][to] + INSERT:
            out.append(("I", -1, to))
            q = to
            continue
        extra = TRUNCATED if code & 4 else 0
        kept = KEEP.get((q, code & 3))
        if kept is not None and now == after[kept] + extra:
            out.append(("K", i, kept))
            q = kept
        else:
            out.append(("R", i, to))
            q = to
        i += 1
    while finish and END[q]:
        q = NEXT[q]
        out.append(("I", -1, q))
    return out, q


def edited(codes: bytes, runs: list[int], roles: list[str], texts: list[str], edits: list[tuple[str, int, int]]) -> tuple[str, int, list[str], list[str]]:
    """Edits as letters, their cost, and the roles and texts they leave."""
    place, nth = [], 0  # roles and texts are those of the rows that are no runs
    for code in codes:
        place.append(nth)
        nth += code != RUN
    letters, cost, out_roles, out_texts = [], 0, [], []
    for edit, i, state in edits:
        if edit == "D":
            n = runs[i]
            letters.append("D" * n)
            cost += DELETE * n
            continue
        letters.append(edit)
        if edit == "I":
            cost += INSERT
            out_roles.append(NAMES[state]), out_texts.append("")
        else:
            cost += (TRUNCATED if codes[i] & 4 else 0) + (REROLE if edit == "R" else 0)
            out_roles.append(NAMES[state] if edit == "R" else roles[place[i]]), out_texts.append(texts[place[i]])
    return "".join(letters), cost, out_roles, out_texts


# Figures of a chunk's rows, before any repair.
_FIGURES = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint, first_initial string, last_initial string"
_CHUNK = f"part int, seq bigint, live bigint, whole boolean, codes binary, runs array<bigint>, roles array<string>, texts array<string>, {_FIGURES}"
_LEGAL = {"su", "ua", "au"}


class _Chunk:
    def __init__(self, conv):
        self.conv, self.codes, self.runs, self.roles, self.texts, self.size = conv, bytearray(), [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn, role: str, code: str, n: int, text: str | None) -> None:
        """``n`` equal rows, the first of them with ``text`` unless all are to be deleted."""
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.illegal += n - 1
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if text is not None:
            kind = "sua".find(initial) if initial else -1
            self.codes.append((3 if kind < 0 else kind) + (4 if code == "T" else 0)), self.runs.append(1)
            self.roles.append(role), self.texts.append(text)
            self.truncated += code == "T"
            self.size += len(text) + len(role)
            n -= 1
        if code == "B":
            self.blank += n
        else:
            self.duplicate += n
        if n and self.codes and self.codes[-1] == RUN:
            self.runs[-1] += n
        elif n:
            self.codes.append(RUN), self.runs.append(n)


def _chunks(chunk_rows: int):
    """Chunks of a range of rows, which come in order, each distinct row with its text before its count."""

    def run(batches):
        part, held, size, seq, live = TaskContext.get().partitionId(), [], 0, 0, 0
        now: _Chunk | None = None
        opened = False  # the conversation is known to start with this chunk
        pending = None
        schema = None

        def close(ended: bool):
            nonlocal seq, live, size
            whole = opened and ended
            some = any(c != RUN for c in now.codes)
            held.append((now, seq, live if some else -1, whole))
            seq, live, size = seq + (not whole), live + (some and not whole), size + now.size + 100

        def flush():
            nonlocal size
            c = [x[0] for x in held]
            columns = [
                pa.array([x.conv for x in c], schema.field("conv_id").type), pa.array([part] * len(c), pa.int32()), pa.array([x[1] for x in held], pa.int64()), pa.array([x[2] for x in held], pa.int64()),
                pa.array([x[3] for x in held]), pa.array([bytes(x.codes) for x in c], pa.binary()), pa.array([x.runs for x in c], pa.list_(pa.int64())),
                pa.array([x.roles for x in c], pa.list_(pa.string())), pa.array([x.texts for x in c], pa.list_(pa.string())),
                *(pa.array([getattr(x, k) for x in c], pa.int64()) for k in ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")),
                *(pa.array([getattr(x, k) for x in c], pa.string()) for k in ("first", "last")),
            ]
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *(x.split()[0] for x in _CHUNK.split(", "))])

        for batch in batches:
            schema = batch.schema
            for conv, turn, role, digest, text, code, n in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "digest", "text", "code", "n")), strict=True):
                if n is None:
                    pending = conv, turn, role, digest, text
                    continue
                own = pending[-1] if pending and pending[:-1] == (conv, turn, role, digest) else None
                pending = None
                if now is None or now.conv != conv:
                    if now is not None:
                        close(True)
                    opened = now is not None  # the first may go on from the range before
                    now = _Chunk(conv)
                elif len(now.roles) >= chunk_rows or now.size >= CHUNK_BYTES:
                    close(False)
                    last_turn, now, opened = now.last_turn, _Chunk(conv), False
                    now.last_turn = last_turn if last_turn == turn else None  # counted already
                now.add(turn, role, code, n, own)
                if size >= 4 * CHUNK_BYTES:
                    yield flush()
        if now is not None:
            close(False)
        if held:
            yield flush()

    return run


def chunks(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of the conversations in ``turns(conv_id, turn, role, text)``; written, as later steps start here."""
    say = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), say("role").alias("role"), say("text").alias("text"))

    def judged(df: DataFrame) -> DataFrame:
        body = F.rtrim(F.col("text"), F.lit(BLANKS))
        code = F.when(body == "", "B").when(F.substring(body, -1, 1).isin(".", "!", "?"), "K").otherwise("T")
        return df.withColumns({"code": code, "digest": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))})

    # the text of a role and text once, where it first occurs; everything else is a count
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    once = judged(rows.groupBy("conv_id", "role", "text").agg(F.min(order)["turn"].alias("turn"))).where("code <> 'B'")
    counts = judged(rows).groupBy("conv_id", "turn", "role", "digest", "code").agg(F.count(F.lit(1)).alias("n"))
    key = ["conv_id", "turn", "role", "digest"]
    both = once.select(*key, "text", "code", F.lit(None).cast("long").alias("n")).unionByName(counts.withColumn("text", F.lit(None).cast("string")))
    kind = dict(turns.dtypes)["conv_id"]
    ordered = both.repartitionByRange(*key).sortWithinPartitions(*key, "n")  # NULL first: the text before the count
    return materialize(ordered.mapInArrow(_chunks(chunk_rows), f"conv_id {kind}, {_CHUNK}"))


def _states(f, *columns: str) -> Column:
    return arrow_udf(f, "array<bigint>")(*[F.col(c) for c in columns])


def _vector(name: str) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in END]).alias(name)


def _left(codes: pa.Array, runs: pa.Array, right: pa.Array) -> pa.Array:
    """Costs before a chunk, less their minimum."""
    rows = zip(codes.to_pylist(), runs.to_pylist(), right.to_pylist(), strict=True)
    return pa.array([normal(vectors(c, n, r)[0]) for c, n, r in rows], pa.list_(pa.int64()))


def _exits(codes: pa.Array, runs: pa.Array, right: pa.Array) -> pa.Array:
    """State in which a chunk is left, by the state in which it is entered."""
    out = []
    for c, n, r in zip(codes.to_pylist(), runs.to_pylist(), right.to_pylist(), strict=True):
        costs = vectors(c, n, r)
        out.append([trace(c, n, costs, q, False)[1] for q in STATES])
    return pa.array(out, pa.list_(pa.int64()))


def _neighbour(df: DataFrame, by: int, **columns: str) -> DataFrame:
    """Add ``columns`` of the chunk ``by`` places on, NULL if that is of another conversation."""
    other = df.select((F.col("g") - by).alias("g"), F.col("conv_id").alias("__conv"), F.struct(*[F.col(old).alias(new) for new, old in columns.items()]).alias("__other"))
    same = F.col("__other").isNotNull() & F.col("conv_id").eqNullSafe(F.col("__conv"))
    joined = df.join(other, "g", "left")
    return joined.withColumns({new: F.when(same, F.col("__other")[new]) for new in columns}).drop("__conv", "__other")


def stitched(long: DataFrame, passes: list[int] | None = None) -> DataFrame:
    """``(part, seq, right, entry, exit, last)`` of the chunks with rows of conversations that
    (may) span several: the costs after the chunk, the states before and after it, and
    whether no such chunk follows. ``passes``, if given, gets the number of chunks run again by each fix-up pass."""
    live = long.where("live >= 0")
    # one row a range
    counts = live.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    state = materialize(
        live.join(F.broadcast(before), "part").select("conv_id", "part", "seq", (F.col("before") + F.col("live")).alias("g"), "codes", "runs", _vector("used"))
        .withColumn("left", _states(_left, "codes", "runs", "used"))
    )
    while True:
        placed = _neighbour(state, 1, next_left="left").withColumn("right", F.coalesce("next_left", _vector("right")))
        stale = placed.where("right <> used")
        n = stale.count()
        if passes is not None:
            passes.append(n)
        if not n:
            break
        again = stale.withColumn("left", _states(_left, "codes", "runs", "right")).withColumn("used", F.col("right"))
        state = materialize(placed.where("right = used").unionByName(again).select(*state.columns))
    maps = materialize(
        _neighbour(placed.withColumn("f", _states(_exits, "codes", "runs", "right")), -1, previous="g")
        .select("conv_id", "part", "seq", "g", "right", F.col("next_left").isNull().alias("last"), "f", "previous")
    )
    whole = maps.select("g", "f", F.col("previous").alias("p"))
    while whole.where("p is not null").limit(1).count():
        earlier = whole.select(F.col("g").alias("p"), F.col("f").alias("f0"), F.col("p").alias("p0"))
        whole = materialize(
            whole.join(earlier, "p", "left")
            .select("g", F.when(F.col("f0").isNull(), F.col("f")).otherwise(F.expr("transform(f0, s -> f[s])")).alias("f"), F.col("p0").alias("p"))
        )
    exits = whole.select("g", F.col("f")[0].alias("exit"))
    entries = exits.select(F.col("g").alias("previous"), F.col("exit").alias("entry"))
    return maps.join(exits, "g").join(entries, "previous", "left").select("part", "seq", "right", F.coalesce("entry", F.lit(0)).alias("entry"), "exit", "last")


_PIECE = "struct<edits:string,cost:bigint,roles:array<string>,texts:array<string>>"


def _repaired(finish: bool):
    @arrow_udf(_PIECE)
    def run(codes: pa.Array, runs: pa.Array, roles: pa.Array, texts: pa.Array, right: pa.Array, entry: pa.Array) -> pa.Array:
        out = []
        for c, n, who, what, r, q in zip(*(x.to_pylist() for x in (codes, runs, roles, texts, right, entry)), strict=True):
            edits, _ = trace(c, n, vectors(c, n, r), q, finish)
            out.append(dict(zip(("edits", "cost", "roles", "texts"), edited(c, n, who, what, edits), strict=True)))
        text = pa.list_(pa.string())
        return pa.array(out, pa.struct([("edits", pa.string()), ("cost", pa.int64()), ("roles", text), ("texts", text)]))

    return run


def repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Repaired conversations in pieces: ``conv_id``, ``whole`` (the piece is a whole conversation),
    ``part`` and ``seq`` (order of the other pieces), ``edits``, ``cost``, the ``roles`` and ``texts``
    that remain, and figures of the damage (``blank``, ``duplicate``, ``truncated``, ``illegal``, turns and
    initials at the ends). ``repaired_turns`` has them row by row."""
    cut = chunks(turns, chunk_rows)
    figures = [x.split()[0] for x in _FIGURES.split(", ")]
    columns = ["conv_id", "whole", "part", "seq", "piece.*", *figures]
    args = [F.col(x) for x in ("codes", "runs", "roles", "texts", "right", "entry")]
    alone = cut.where("whole").withColumns({"right": _vector("right"), "entry": F.lit(0)}).withColumn("piece", _repaired(True)(*args))
    long = cut.where("not whole")
    states = materialize(stitched(long))
    placed = long.where("live >= 0").join(states.drop("exit", "last"), ["part", "seq"]).withColumn("piece", _repaired(False)(*args))
    none = "named_struct('edits', {}, 'cost', {}, 'roles', {}, 'texts', {})".format
    # nothing but runs: all deleted
    runs = "aggregate(runs, 0L, (s, x) -> s + x)"
    gone = long.where("live < 0").withColumn("piece", F.expr(none(f"repeat('D', cast({runs} as int))", f"{DELETE} * {runs}", "array()", "array()")).cast(_PIECE))
    # what the end of a conversation lacks comes after all deletions
    lacks = F.when(F.col("exit") == 1, 2).otherwise(1)
    ends = (
        long.select("conv_id", "part", "seq", "whole").join(states.where("last and exit in (1, 2)").select("part", "seq", lacks.alias("lacks")), ["part", "seq"])
        .withColumn("piece", F.expr(none("repeat('I', lacks)", f"{INSERT}L * lacks", "slice(array('user', 'assistant'), -lacks, lacks)", "array_repeat('', lacks)")).cast(_PIECE))
        .select("conv_id", "whole", F.lit(2**31 - 1).alias("part"), "seq", "piece.*", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in _FIGURES.split(", ")])
    )
    return alone.select(*columns).unionByName(placed.select(*columns)).unionByName(gone.select(*columns)).unionByName(ends)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``(conv_id, part, seq, nth, role, text)``: the rows of repaired conversations, in order of the last three numbers."""
    both = F.arrays_zip("roles", "texts")
    return pieces.select("conv_id", "part", "seq", F.posexplode(both).alias("nth", "row")).select("conv_id", "part", "seq", "nth", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


_DIGEST = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _joined(batches):
    """Digests of conversations whose pieces come in order; one piece at a time is held."""
    now, schema, out = None, None, []

    def close():
        low, high, turns = now["first_turn"], now["last_turn"], now["turns"]
        out.append((now["conv"], 0 if low is None else high - low + 1 - turns, *(now[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")), "".join(now["edits"]), now["sha"].hexdigest()))

    def flush():
        columns = list(zip(*out, strict=True))
        kinds = [schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", *(x.split()[0] for x in _DIGEST.split(", "))])

    for batch in batches:
        schema = batch.schema
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            if now is None or now["conv"] != row["conv_id"]:
                if now is not None:
                    close()
                now = {"conv": row["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "turns": 0, "first_turn": None, "last_turn": None, "last": None, "edits": [], "sha": hashlib.sha256(), "rows": 0}
            now["edits"].append(row["edits"])
            now["cost"] += row["cost"]
            for role, text in zip(row["roles"], row["texts"], strict=True):
                now["sha"].update(("\n" if now["rows"] else "").encode() + f"{role}:{text}".encode())
                now["rows"] += 1
            if row["blank"] is None:
                continue
            for k in ("blank", "duplicate", "truncated", "illegal"):
                now[k] += row[k]
            if now["last"] is not None:
                now["illegal"] += now["last"] + row["first_initial"] not in _LEGAL
            now["last"] = row["last_initial"]
            if row["first_turn"] is not None:
                now["turns"] += row["turns"] - (row["first_turn"] == now["last_turn"])
                now["first_turn"] = row["first_turn"] if now["first_turn"] is None else now["first_turn"]
            now["last_turn"] = row["last_turn"] if row["last_turn"] is not None else now["last_turn"]
        if out:
            yield flush()
    if now is not None:
        close()
        yield flush()


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation: figures, edits and the SHA-256 of ``role:text`` lines. A hash is
    sequential, so the pieces of one conversation pass through one task, one piece in memory at a time."""
    lines = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit(":"), x["texts"])), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    columns = [x.split()[0] for x in _DIGEST.split(", ")]
    alone = pieces.where("whole").withColumns({"gaps": gaps, "audit": F.col("edits"), "repaired_sha256": F.sha2(lines, 256)}).select("conv_id", *columns)
    kind = dict(pieces.dtypes)["conv_id"]
    long = pieces.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return alone.unionByName(long.mapInArrow(_joined, f"conv_id {kind}, {_DIGEST}"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: by crc32(``conv_id:turn``) mod 20 a row is dropped (0), emptied (1), loses
    its ``[.!?]`` (2), comes twice (3) or becomes a user's (4)."""
    say = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(say("conv_id"), F.lit(":"), say("turn"))) % 20
    rows = conversations.select("conv_id", "turn", say("role").alias("role"), say("text").alias("text"), how.alias("how")).where("how <> 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("how") == 3, 2).otherwise(1)
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = digests(repair(damaged(conversations)))
    ids = conversations.select("conv_id").distinct()
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    joined = ids.join(found.withColumnRenamed("conv_id", "found"), F.col("conv_id").eqNullSafe(F.col("found")), "left")
    return joined.select("conv_id", *[F.coalesce(x.split()[0], F.lit(empty.get(x.split()[0], 0))).alias(x.split()[0]) for x in _DIGEST.split(", ")])


# DuckDB: crc32 by its bits, then the cheapest edits of all conversations, a row at a time.
ORACLE = r"""
WITH RECURSIVE
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc AS (SELECT *, xor(4294967295::BIGINT, list_reduce(
          list_prepend(4294967295::BIGINT, list_transform(range(1, len(k) + 1), lambda i: CAST(ord(substr(k, i, 1)) AS BIGINT))),
          lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 20 AS how FROM src),
dam AS (SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
        CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE how WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM crc WHERE how <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), copy) AS i FROM dam),
said AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
r AS (SELECT conv_id, turn, role, text, i, before, substr(role, 1, 1) AS c,
      CASE WHEN body = '' THEN 'B' WHEN nth > 1 THEN 'D' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'T' ELSE 'K' END AS fault FROM said),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'B') AS blank,
          count(*) FILTER (fault = 'D') AS duplicate, count(*) FILTER (fault = 'T') AS truncated,
          count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM r GROUP BY conv_id),
ins(q, q2, cost, audit, said) AS (VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
  (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])),
move(q, c, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
role(q, name, q2) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
walk(conv_id, i, q, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]} FROM facts
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.q2, min({'cost': w.best.cost + s.cost + e.cost, 'audit': w.best.audit || s.audit || e.edit, 'said': w.best.said || s.said || e.said})
  FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN ins s ON s.q = w.q,
  LATERAL (SELECT s.q2, 2 AS cost, 'D' AS edit, []::VARCHAR[] AS said
           UNION ALL SELECT m.q2, CASE r.fault WHEN 'T' THEN 5 ELSE 0 END, 'K', [r.role || ':' || r.text] FROM move m WHERE m.q = s.q2 AND m.c = r.c AND r.fault IN ('K', 'T')
           UNION ALL SELECT o.q2, 1 + CASE r.fault WHEN 'T' THEN 5 ELSE 0 END, 'R', [o.name || ':' || r.text] FROM role o WHERE o.q = s.q2 AND r.fault IN ('K', 'T')) e
  GROUP BY w.conv_id, w.i, e.q2),
done AS (SELECT f.conv_id, min({'cost': w.best.cost + s.cost, 'audit': w.best.audit || s.audit, 'said': w.best.said || s.said}) AS best
         FROM facts f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.n JOIN ins s ON s.q = w.q AND s.q2 IN (0, 3) GROUP BY f.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(d.best.cost, 0)::BIGINT AS cost, coalesce(d.best.audit, '') AS audit, sha256(coalesce(array_to_string(d.best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""
