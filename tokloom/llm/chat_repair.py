"""Repair of conversation structure by iterative-deepening A*.

A conversation should be an optional system turn and then pairs of user and assistant turns. Rows are judged
first (blank, duplicate, truncated); the cheapest edits that give such a structure are then searched:

    D delete, 2 (the only edit of blank and duplicate rows)     I insert an empty user or assistant turn, 5
    K keep, 0 (5 when truncated)                                R give the role user or assistant, 1 (6 when truncated)

The search is a depth-first walk in ASCII order of the edits' letters under a cost bound. The bound starts at the
least that the rows can cost and rises to the least cost that the last walk had to leave out. A table holds for
every (row, state) the most that was left to spend when it failed, so nothing is walked twice in a
round. The first path that is accepted is the cheapest, and of those the least in ASCII order. The state is what the
next turn may be; it fixes which role an insertion or a new role gives.

Conversations of up to ``LONG_ROWS`` rows and ``LONG_BYTES`` bytes are gathered and searched whole. A longer one,
which may be a third of all rows, is never gathered: its equal rows are counted before anything is shuffled,
its rows are ordered by range partitions and cut into segments of ``SEGMENT`` rows, each segment is searched once
for every pair of states it may begin and end in, and the segments are joined in order by what is cheapest, then
least. Only the hash of a long conversation's repaired text is computed in one task, since SHA-256 has to see all
bytes in order; it streams, so memory stays bounded.

The order of a conversation's rows is by turn (null first), then role, then text, so ties have one result. Initials
are the first characters of roles; an empty role has none and fits nowhere.

Edge cases: null role or text count as one space, and so does a null id or turn in the text that is hashed for damage.
Rows without a conversation id are one conversation whose id is null. A conversation that loses all rows has zeros, an
empty audit and the hash of no bytes. Empty tables give no rows. Extra columns are never read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokloom.llm.common import named_rows, stored

LONG_ROWS, LONG_BYTES, SEGMENT = 1000, 1 << 20, 256
_AT_ONCE = 64  # conversations of a batch held as Python objects
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
ROLES = {"u": "user", "a": "assistant"}
#: What the next turn may be: s or u at the start; u after s; a after u; u, or the end, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
GIVEN = ("u", "u", "a", "u")
#: Insertions that end the structure from each state.
CLOSING = (0, 2, 1, 0)
#: A row is its initial in lower case, in upper case when it is truncated, or this when it has to go.
GONE = "-"

_SPACE = r"[\x20\x09-\x0D]"
_EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def _least_costs(rows: str) -> list[int]:
    """What the rows from each place on cost at least; two equal neighbours of which both stay need an edit."""
    least = [0] * (len(rows) + 2)
    for i in range(len(rows) - 1, -1, -1):
        c = rows[i]
        own = DELETE if c == GONE or c.isupper() else 0 if c in "sua" else REROLE
        least[i] = own + least[i + 1]
        if rows[i + 1:i + 2] == c and c in "sua":
            least[i] = max(least[i], 1 + least[i + 2])
    return least[:-1]


def _edits(rows: str, i: int, state: int, closing: bool) -> list[tuple[str, int, int, int]]:
    """(letter, cost, next row, next state) in ASCII order."""
    out = []
    given = NEXT[state][GIVEN[state]]
    if i < len(rows):
        c = rows[i]
        out.append(("D", DELETE, i + 1, state))
        out.append(("I", INSERT, i, given))
        if c != GONE:
            more = TRUNCATED if c.isupper() else 0
            to = NEXT[state].get(c.lower())
            if to is not None:
                out.append(("K", more, i + 1, to))
            out.append(("R", more + REROLE, i + 1, given))
    elif closing:
        out.append(("I", INSERT, i, given))
    return out


def search(rows: str, start: int = START, end: int | None = None) -> tuple[int, str]:
    """(cost, letters) of the cheapest edits of ``rows`` from state ``start``, the least in ASCII order.

    Without ``end`` the structure is finished; with it, the edits stop with the last row in that state. It has to be
    within reach.
    """
    least = _least_costs(rows)
    n, closing = len(rows), end is None
    bound = least[0]
    while True:
        failed: dict[tuple[int, int], int] = {}
        over = None
        letters: list[str] = []
        walk = [iter([("", 0, 0, start)])]
        left = [bound]
        while walk:
            step = next(walk[-1], None)
            if step is None:
                walk.pop()
                left.pop()
                if letters:
                    letters.pop()
                continue
            letter, cost, i, state = step
            rest = left[-1] - cost
            if rest < least[i]:
                beyond = bound + least[i] - rest
                over = beyond if over is None else min(over, beyond)
                continue
            if failed.get((i, state), -1) >= rest:
                continue
            if i == n and (state == end if not closing else CLOSING[state] == 0):
                return bound - rest, "".join([*letters, letter])
            # set before the walk goes on: a path that comes back here with less has no use
            failed[i, state] = rest
            letters.append(letter)
            left.append(rest)
            walk.append(iter(_edits(rows, i, state, closing)))
        if over is None:
            raise ValueError("no edits lead there")
        bound = over


def segment_searches(rows: str) -> list[tuple[int, int, int, str]]:
    """(begin, end, cost, letters) for all pairs of states that a segment may begin and end in."""
    out = []
    for begin in range(4):
        for end in range(4):
            if end == START and begin != START:
                continue
            if end == AFTER_S and begin != AFTER_S and not (begin == START and "s" in rows.lower()):
                continue
            out.append((begin, end, *search(rows, begin, end)))
    return out


def repaired(rows: str, letters: str, state: int = START) -> list[tuple[int, str | None]]:
    """(row number or -1 for an inserted one, new role or None) of each turn that the edits leave."""
    out, i = [], 0
    for letter in letters:
        if letter == "I":
            out.append((-1, ROLES[GIVEN[state]]))
            state = NEXT[state][GIVEN[state]]
            continue
        if letter == "K":
            out.append((i, None))
            state = NEXT[state][rows[i].lower()]
        elif letter == "R":
            out.append((i, ROLES[GIVEN[state]]))
            state = NEXT[state][GIVEN[state]]
        i += 1
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after the damage that the crc of ``conv_id:turn`` decides."""
    space = F.lit(" ")
    rows = named_rows(conversations, conv_id="long", turn="long", role="string", text="string").select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` with blank and truncated (the last character that is no space is no ``.!?``)."""
    blank = ~F.col("text").rlike(rf"[^\x20\x09-\x0D]")
    return rows.withColumn("blank", blank).withColumn(
        "truncated", ~blank & ~F.col("text").rlike(rf"[.!?]{_SPACE}*\z"))


def _code(role: str, truncated: bool) -> str:
    """The row's letter. Initials that fit nowhere are all one; they never differ in what may be done."""
    c = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return c.upper() if truncated else c


def _illegal(initials: list[str]) -> int:
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = f"conv_id long, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"


def _judge(rows: list[dict]) -> tuple[str, list[int]]:
    """(letters of the rows, [blank, duplicate, truncated]) of a conversation's rows in order."""
    seen, codes, faults = set(), [], [0, 0, 0]
    for r in rows:
        said = (r["role"], r["text"])
        if r["blank"] or said in seen:
            faults[0 if r["blank"] else 1] += 1
            codes.append(GONE)
        else:
            faults[2] += r["truncated"]
            codes.append(_code(r["role"], r["truncated"]))
        seen.add(said)
    return "".join(codes), faults


def _repair(conv, rows: list[dict]) -> tuple:
    codes, faults = _judge(rows)
    cost, letters = search(codes)
    lines = [f"{role}:" if i < 0 else f"{role or rows[i]['role']}:{rows[i]['text']}"
             for i, role in repaired(codes, letters)]
    turns = {r["turn"] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *faults, _illegal([r["role"][:1] for r in rows]), cost, letters,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _whole(batches):
    """One conversation a row: its rows as sorted structs."""
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    kinds = [pa.int64()] * (1 + len(_COUNTS)) + [pa.string()] * 2
    for batch in batches:
        out = []
        for at in range(0, batch.num_rows, _AT_ONCE):
            some = batch.slice(at, _AT_ONCE)
            out += map(_repair, some.column("conv_id").to_pylist(), some.column("rows").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)


def _short(rows: DataFrame) -> DataFrame:
    """Conversations that fit in a row."""
    order = F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn", "role", "text", "blank", "truncated")
    copies = F.explode(F.sequence(F.lit(1), "copies"))
    return (rows.select("conv_id", order.alias("r"), copies).groupBy("conv_id")
            .agg(F.array_sort(F.collect_list("r")).alias("rows")).mapInArrow(_whole, _RESULT))


def _segments(batches, segment: int):
    """Sorted rows of one range partition, cut into segments; runs of equal rows become rows of their own."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    conv, number, place = object(), 0, 0
    for batch in batches:
        out = {c: [] for c in ("conv_id", "part", "segment", "place", "code", "initial", "role", "text")}
        for r in batch.to_pylist():
            if r["conv_id"] != conv:
                conv, number, place = r["conv_id"], 0, 0
            first = GONE if r["blank"] or r["again"] else _code(r["role"], r["truncated"])
            for k in range(r["copies"]):
                if place == segment:
                    number, place = number + 1, 0
                code = first if k == 0 else GONE
                for c, v in (("conv_id", conv), ("part", part), ("segment", number), ("place", place), ("code", code),
                             ("initial", r["role"][:1]), ("role", r["role"]),
                             ("text", None if code == GONE else r["text"])):
                    out[c].append(v)
                place += 1
                if len(out["code"]) >= 4096:
                    yield _rows_of_segments(out)
                    out = {c: [] for c in out}
        yield _rows_of_segments(out)


def _rows_of_segments(out: dict) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "part": pa.int32(), "segment": pa.int64(), "place": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()], list(out))


def _searched(batches):
    """A segment a row: costs and ranks of all searches, 16 numbers each (-1: not within reach), and letters;
    and the first and last initials with the number of illegal neighbours between."""
    for batch in batches:
        costs, ranks, letters, edges = [], [], [], []
        for codes, initials in zip(batch.column("codes").to_pylist(), batch.column("initials").to_pylist()):
            edges.append((initials[0], initials[-1], _illegal(initials)))
            cost, found = [-1] * 16, [None] * 16
            for begin, end, c, path in segment_searches(codes):
                cost[4 * begin + end], found[4 * begin + end] = c, path
            costs.append(cost)
            letters.append(found)
            # the order of the paths that begin alike; they end differently, so they differ
            rank = [0] * 16
            for begin in range(4):
                own = sorted((p, e) for e, p in enumerate(found[4 * begin:4 * begin + 4]) if p is not None)
                for k, (_, e) in enumerate(own):
                    rank[4 * begin + e] = k
            ranks.append(rank)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "part", "segment", "codes")), pa.array(costs, pa.list_(pa.int64())),
             pa.array(ranks, pa.list_(pa.int32())), pa.array(letters, pa.list_(pa.string())),
             *(pa.array([e[k] for e in edges]) for k in range(3))],
            ["conv_id", "part", "segment", "codes", "costs", "ranks", "letters", "first", "last", "illegal"])


def join_segments(segments: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """(cost, the state that each segment begins in, and the last ends in) of the cheapest, then least, path
    through segments of (costs, ranks).

    Paths that meet in a state are compared by cost, then by their letters: by the order of the states they came
    through when they differ there. No path begins another, since every segment's letters end with a row.
    """
    costs, ranks, back = {START: 0}, {START: 0}, []
    for cost, rank in segments:
        step: dict[int, tuple] = {}
        for begin, so_far in costs.items():
            for end in range(4):
                if cost[4 * begin + end] >= 0:
                    way = (so_far + cost[4 * begin + end], (ranks[begin], rank[4 * begin + end]), begin)
                    if end not in step or way < step[end]:
                        step[end] = way
        order = {key: k for k, key in enumerate(sorted(way[1] for way in step.values()))}
        costs = {end: way[0] for end, way in step.items()}
        ranks = {end: order[way[1]] for end, way in step.items()}
        back.append({end: way[2] for end, way in step.items()})
    total, _, state = min((c + INSERT * CLOSING[s], ranks[s], s) for s, c in costs.items())
    states = [state]
    for step in reversed(back):
        states.append(step[states[-1]])
    return total, states[::-1]


def _joined(batches):
    """Segments sorted by conversation and place: the states each begins and ends in, its illegal neighbours
    with the first of the next, and with the last one the closing insertions and the total cost. Of a
    conversation's segments 16 costs and ranks each are held."""
    def done(conv, rows):
        cost, states = join_segments([(r["costs"], r["ranks"]) for r in rows])
        n = len(rows)
        edge = [_illegal([a["last"], b["first"]]) for a, b in zip(rows, rows[1:])] + [0]
        return pa.RecordBatch.from_arrays(
            [pa.array([conv] * n, pa.int64()), pa.array([r["part"] for r in rows], pa.int32()),
             pa.array([r["segment"] for r in rows], pa.int64()), pa.array(states[:-1], pa.int32()),
             pa.array(states[1:], pa.int32()), pa.array([0] * (n - 1) + [CLOSING[states[-1]]], pa.int32()),
             pa.array([0] * (n - 1) + [cost], pa.int64()),
             pa.array([r["illegal"] + e for r, e in zip(rows, edge)], pa.int64())],
            ["conv_id", "part", "segment", "begin", "end", "closing", "cost", "illegal"])

    conv, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if rows and r["conv_id"] != conv:
                yield done(conv, rows)
                rows = []
            conv = r.pop("conv_id")
            rows.append(r)
    if rows:
        yield done(conv, rows)


def _applied(batches):
    """A segment a row, with its letters: the turns that they leave."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            closing = "I" * r["closing"]
            for k, (i, role) in enumerate(repaired(r["codes"], r["letters"] + closing, r["begin"])):
                out.append((r["conv_id"], r["part"], r["segment"], k, i, role))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                                         ["conv_id", "part", "segment", "turn_no", "place", "new_role"])


def _hashed(batches):
    """Turns sorted by conversation and place: the hash of each conversation, streamed."""
    conv, digest = None, None
    for batch in batches:
        out = []
        for c, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
            if digest is None or c != conv:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256(line.encode())
            else:
                digest.update(b"\n" + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                          pa.array([o[1] for o in out], pa.string())], ["conv_id", "repaired_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])],
                                         ["conv_id", "repaired_sha256"])


def _long(rows: DataFrame, segment: int) -> DataFrame:
    """Conversations of any length."""
    spark = rows.sparkSession
    runs = (rows.groupBy("conv_id", "turn", "role", "text", "blank", "truncated")
            .agg(F.sum("copies").cast("long").alias("copies")))
    runs = stored(runs, "chat-runs")
    # the first turn of each text; nulls come first, so one null makes it null
    order = F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn")
    first = (runs.groupBy("conv_id", "role", F.sha2("text", 256).alias("said")).agg(F.min(order).alias("first")))
    # (a text's digest, not the text, is shuffled twice)
    again = (runs.alias("r").join(first.alias("f"), F.col("r.conv_id").eqNullSafe(F.col("f.conv_id"))
                                  & (F.col("r.role") == F.col("f.role"))
                                  & (F.sha2("r.text", 256) == F.col("f.said")))
             .select("r.*", (~F.col("r.turn").eqNullSafe(F.col("f.first.turn"))).alias("again")))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = stored(again.repartitionByRange(width, *keys).sortWithinPartitions(*keys).mapInArrow(
        lambda b: _segments(b, segment), "conv_id long, part int, segment long, place int, code string, "
        "initial string, role string, text string"), "chat-lines")
    at = ["conv_id", "part", "segment"]
    texts = (lines.groupBy(*at).agg(F.array_sort(F.collect_list(F.struct("place", "code", "initial"))).alias("l"))
             .select(*at, F.array_join(F.col("l.code"), "").alias("codes"), F.col("l.initial").alias("initials")))
    texts = stored(texts, "chat-segments")
    searched = stored(texts.mapInArrow(
        _searched, "conv_id long, part int, segment long, codes string, costs array<long>, ranks array<int>, "
        "letters array<string>, first string, last string, illegal long"), "chat-searches")
    joined = stored(searched.select(*at, "costs", "ranks", "first", "last", "illegal")
                    .repartition(width, "conv_id").sortWithinPartitions(*at)
                    .mapInArrow(_joined, "conv_id long, part int, segment long, begin int, end int, closing int, "
                                "cost long, illegal long"), "chat-states")
    same = lambda a, b: (F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
                         & (F.col(f"{a}.part") == F.col(f"{b}.part")) & (F.col(f"{a}.segment") == F.col(f"{b}.segment")))
    paths = (joined.alias("j").join(searched.alias("s"), same("j", "s"))
             .select("j.*", "s.codes", F.col("s.letters")[F.col("j.begin") * 4 + F.col("j.end")].alias("letters")))
    paths = stored(paths, "chat-paths")
    written = F.concat("letters", F.expr("repeat('I', closing)"))
    audits = (paths.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "segment", written.alias("l")))).alias("all"),
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
        .select("conv_id", "cost", "illegal", F.array_join(F.col("all.l"), "").alias("audit")))
    turns = paths.select(*at, "begin", "codes", "letters", "closing").mapInArrow(
        _applied, "conv_id long, part int, segment long, turn_no int, place int, new_role string")
    line = F.concat(F.coalesce("t.new_role", "l.role"), F.lit(":"), F.coalesce("l.text", F.lit("")))
    said = (turns.alias("t").join(lines.filter("text is not null").alias("l"),
                                  same("t", "l") & (F.col("t.place") == F.col("l.place")), "left")
            .select("t.conv_id", "t.part", "t.segment", "t.turn_no", line.alias("line")))
    hashes = (said.repartition(width, "conv_id").sortWithinPartitions("conv_id", "part", "segment", "turn_no")
              .select("conv_id", "line").mapInArrow(_hashed, "conv_id long, repaired_sha256 string"))
    spare = F.col("copies") - F.when(F.col("again"), 0).otherwise(1)
    faults = (again.groupBy("conv_id").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), spare).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("truncated") & ~F.col("again"), 1).otherwise(0)).alias("truncated")))
    # distinct turns by two steps, so a conversation's turns are not one group's set
    gaps = (runs.filter("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
             .groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    out = stored(faults, "chat-faults")
    for more in (gaps, audits, hashes):
        more = more.withColumnRenamed("conv_id", "of")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    return out.select("conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.coalesce("repaired_sha256", F.lit(_EMPTY_HASH)).alias("repaired_sha256"))


def repair(conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES,
           segment: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation
    of a table that is damaged first."""
    rows = damaged(conversations)
    sizes = stored(rows.groupBy("conv_id").agg(
        F.sum("copies").alias("n"), F.sum(F.col("copies") * (F.octet_length("text") + F.octet_length("role") + 32))
        .alias("bytes")), "chat-sizes")
    there = judged(rows.filter("copies > 0"))
    long = sizes.filter((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select(
        F.col("conv_id").alias("of"))
    none = (sizes.filter("n = 0").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in _COUNTS], F.lit("").alias("audit"),
        F.lit(_EMPTY_HASH).alias("repaired_sha256")))
    if long.isEmpty():
        return _short(there).unionByName(none)
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    return (_short(there.join(long, same, "left_anti")).unionByName(_long(there.join(long, same, "left_semi"), segment))
            .unionByName(none))
