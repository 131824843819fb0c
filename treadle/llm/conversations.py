"""Repair of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``.

Messages are reduced to small rows (turn, role, hash of the text, fault), put in order over range
partitions and cut into chunks, each a part of one conversation.  The search for the cheapest edits is a
Viterbi pass from the end with four states, run by rank convergence: every chunk starts at once from a
speculative cost vector; fix-up passes run a chunk again from the vector its right neighbour has found,
until the vectors differ from the earlier ones only by a constant.  Vectors are kept less their least
entry, so that is equality.  A run of one role never converges, as its costs depend on parity; chunks
still wrong after ``PASSES`` get their cost matrices, which are combined by doubling, so the number of
passes stays logarithmic.  With the stitched costs each chunk traces its edits for each state it may be
entered in, neighbours' maps are combined the same way, and the trace from the right state is the answer.

Texts join their edits in the last step only, in the order of the conversation and as a stream, so a
conversation of any length is never held in memory.  The digest of a whole conversation is sequential by
nature, so that step has a task per conversation.

Order: by turn (nulls first), then role, then hash of the text; equal rows are one row with a number
of copies.  Edits: keep 0, re-role 2, delete 3, insert 2, an undeleted truncated row 1 more.

Defined results: null roles and texts count as one space; a blank message is deleted; roles that are
neither system, user nor assistant by their first letter (case counts) can only be re-roled or deleted;
equal rows are duplicates of their first; a null conversation id is a conversation like any other; a
conversation without rows has zeros, an empty audit and the hash of the empty string; an empty table
gives no rows; other columns are not looked at; a gap count beyond a long is the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from io import StringIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from treadle.llm.batches import map_texts
from treadle.session import run_folder

#: Most rows of a chunk, and fix-up passes before chunks that do not converge are combined by doubling.
CHUNK, PASSES = 256, 4
SPACES = " \t\n\x0b\x0c\r"

# States: before any message, behind a system, a user and an assistant message.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State and role that an inserted or re-roled message gives in each state.
NEXT, WRITES = (USER, USER, ASSISTANT, USER), ("user", "user", "assistant", "user")
#: Costs at the end of a conversation: inserts that complete it.
END = (0, 4, 2, 0)
SPECULATIVE = (0, 0, 0, 0)
FAR = 1 << 20
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Code of a message that has to be deleted; others are twice the role's number plus 1 if truncated.
GONE = 8
ROLES = {"s": 0, "u": 1, "a": 2}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def code_of(role: str, fault: int) -> int:
    return GONE if fault in (BLANK, DUPLICATE) else 2 * ROLES.get(role[:1], 3) + (fault == TRUNCATED)


def kept(code: int, state: int) -> int | None:
    """The state behind a message that stays as it is, or None where it can't."""
    role = code >> 1
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def closed(costs: Iterable[int]) -> list[int]:
    """Costs when messages may be inserted first."""
    b = list(costs)
    for _ in range(2):
        b = [min(b[q], 2 + b[NEXT[q]]) for q in range(4)]
    return b


@cache
def step(behind: tuple, code: int) -> tuple[tuple, int]:
    """Costs in front of a message from those behind it: less their least, and that least."""
    b = [3 + c for c in behind]
    if code != GONE:
        more = code & 1
        for q in range(4):
            stay = kept(code, q)
            b[q] = min(b[q], 2 + more + behind[NEXT[q]], more + behind[stay] if stay is not None else FAR)
    b = closed(b)
    low = min(b)
    return tuple(min(c - low, FAR) for c in b), low


@cache
def choose(behind: tuple, code: int, state: int) -> tuple[str, int]:
    """The letters of the cheapest edits up to and with this message, least in ASCII, and the state behind it."""
    front, low = step(behind, code)
    letters = ""
    while True:
        cost = front[state] + low
        if 3 + behind[state] == cost:
            return letters + "D", state
        if 2 + front[NEXT[state]] + low == cost:
            letters, state = letters + "I", NEXT[state]
            continue
        stay = kept(code, state)
        if stay is not None and (code & 1) + behind[stay] == cost:
            return letters + "K", stay
        return letters + "R", NEXT[state]


def front_of(codes: bytes, behind: tuple) -> tuple:
    for code in reversed(codes):
        behind, _ = step(behind, code)
    return behind


def fixed(codes: bytes, old: tuple, new: tuple, front: tuple) -> tuple:
    """The front from a new vector behind; ends where it meets the vectors of the earlier run."""
    for code in reversed(codes):
        if old == new:
            return front
        old, new = step(old, code)[0], step(new, code)[0]
    return new


def matrix_of(codes: bytes) -> list[int]:
    """Least costs from each state in front (rows) to each behind, less the least of them."""
    columns = []
    for target in range(4):
        now, low = tuple(closed(0 if q == target else FAR for q in range(4))), 0
        for code in reversed(codes):
            now, more = step(now, code)
            low += more
        columns.append([c + low if c < FAR // 2 else FAR for c in now])
    least = min(min(c) for c in columns)
    return [min(columns[r][q] - least, FAR) for q in range(4) for r in range(4)]


def trace(codes: bytes, behind: tuple, state: int) -> tuple[list[str], int]:
    """Letters of each message of a chunk that is entered in a state, and the state behind it."""
    vectors = [behind]
    for code in reversed(codes):
        vectors.append(step(vectors[-1], code)[0])
    out = []
    for k, code in enumerate(codes):
        letters, state = choose(vectors[len(codes) - 1 - k], code, state)
        out.append(letters)
    return out, state


# --- in Spark --------------------------------------------------------------------------------


def damage(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Messages ``conv``, ``turn``, ``role``, ``text`` with damage drawn from the hash of id and turn."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
                       (F.crc32(F.concat(part(conversation), F.lit(":"), part(turn))) % 20).alias("draw"))
    hit = rows.where("draw <> 0").withColumn("text", F.when(F.col("draw") == 1, "").when(
        F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))).withColumn(
        "role", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")))
    return hit.select("conv", "turn", "role", "text", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))).alias("copy")).drop("copy")


def _hash() -> Column:
    return F.sha2("text", 256).alias("hash")


def faults(messages: DataFrame) -> DataFrame:
    """Small rows ``conv``, ``turn``, ``role``, ``hash``, ``copies`` and ``fault`` of the first copy."""
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    small = messages.select("conv", "turn", "role", _hash(), end.alias("end")).groupBy(
        "conv", "turn", "role", "hash", "end").agg(F.count("*").alias("copies"))
    first = small.where("end <> ''").groupBy("conv", "role", "hash").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"), "first")
    own = small.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h")), "left")
    fault = F.when(F.col("end") == "", BLANK).when(~F.col("turn").eqNullSafe(F.col("first.turn")), DUPLICATE).when(
        ~F.col("end").isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    return own.select("conv", "turn", "role", "hash", "copies", fault.alias("fault"))


def _chunk_schema(conv: str) -> str:
    return (f"conv {conv}, part int, number long, goes_on boolean, codes binary, turns array<bigint>, "
            "roles array<string>, hashes array<string>, copies array<bigint>, faults array<int>")


def _chunks_of(records: Iterable[tuple], most: int) -> Iterator[tuple]:
    """Chunks of rows in order; ``goes_on``: a neighbour may belong to the same conversation."""
    own: list[tuple] = []
    number, split = 0, True  # the first chunk of a partition may go on from the partition before

    def chunk(last: bool) -> tuple:
        codes = bytes(code_of(r[2], r[5]) for r in own)
        return (own[0][0], own[0][6], number, split or last, codes, *([r[k] for r in own] for k in (1, 2, 3, 4, 5)))

    for r in records:
        if own and (r[0] != own[0][0] or len(own) == most):
            same = r[0] == own[0][0]
            yield chunk(same)
            number, split, own = number + 1, same, []
        own.append(r)
    if own:
        yield chunk(True)


def chunked(spark: SparkSession, small: DataFrame, most: int = CHUNK) -> DataFrame:
    """Stored chunks with a number ``g`` that rises by 1 along the order of all rows."""
    conv = small.schema["conv"].dataType.simpleString()
    kind = StructType.fromDDL(_chunk_schema(conv))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        schema, out, held = to_arrow_schema(kind), [], 0
        for c in _chunks_of(records, most):
            out.append(c)
            held += len(c[4])
            if held >= 4096:
                yield _batch(out, schema)
                out, held = [], 0
        if out:
            yield _batch(out, schema)

    ordered = small.repartitionByRange("conv", "turn", "role", "hash").sortWithinPartitions("conv", "turn", "role", "hash")
    folder = run_folder(spark, "conversation-chunks")
    ordered.withColumn("part", F.spark_partition_id()).mapInArrow(run, kind).write.parquet(folder)
    stored = spark.read.parquet(folder)
    starts, n = [], 0
    for r in stored.groupBy("part").agg(F.max("number").alias("most")).orderBy("part").collect():  # a row per partition
        starts.append((r.part, n))
        n += r.most + 1
    starts = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    return stored.join(starts, "part").withColumn("g", F.col("number") + F.col("start")).drop("part", "number", "start")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    folder = run_folder(spark, name)
    rows.write.parquet(folder)
    return spark.read.parquet(folder)


def _beside(rows: DataFrame, other: DataFrame, distance: int, columns: dict[str, str]) -> DataFrame:
    """Each row with columns of the chunk ``distance`` further on in the same conversation, else null."""
    other = other.select(F.col("conv").alias("_c"), (F.col("g") - distance).alias("_g"),
                         *[F.col(c).alias(n) for n, c in columns.items()])
    return rows.join(other, (F.col("g") == F.col("_g")) & F.col("conv").eqNullSafe(F.col("_c")), "left").drop("_c", "_g")


def _vector(costs: tuple) -> Column:
    return F.array(*[F.lit(c) for c in costs])


def costs(spark: SparkSession, parts: DataFrame, passes: int = PASSES) -> DataFrame:
    """``behind`` of each chunk (``conv``, ``g``, ``codes``): the cost vector behind its last message."""
    conv = parts.schema["conv"].dataType.simpleString()

    def speculate():
        return lambda records: ((c, g, last, codes, list(b), list(front_of(codes, tuple(b)))) for c, g, last, codes, b in records)

    def fix():
        return lambda records: ((c, g, last, codes, list(new), list(fixed(codes, tuple(old), tuple(new), tuple(front))))
                                for c, g, last, codes, old, front, new in records)

    kind = f"conv {conv}, g long, last boolean, codes binary, behind array<int>, front array<int>"
    own = _beside(parts.select("conv", "g", "codes"), parts, 1, {"_next": "g"}).withColumn("last", F.col("_next").isNull())
    first = own.select("conv", "g", "last", "codes", F.when(F.col("last"), _vector(END)).otherwise(_vector(SPECULATIVE)).alias("behind"))
    now = _stored(spark, map_texts(first, speculate, kind), "conversation-costs")
    for done in range(passes + 1):
        told = _beside(now, now, 1, {"told": "front"}).withColumn(
            "right", F.col("last") | (F.col("told") == F.col("behind")))
        if told.where("not right").isEmpty():
            return now.select("conv", "g", "behind")
        if done < passes:
            again = told.where("not right").select("conv", "g", "last", "codes", "behind", "front", "told")
            now = _stored(spark, told.where("right").drop("told", "right").unionByName(map_texts(again, fix, kind)), "conversation-costs")
    return _by_doubling(spark, now, kind)


def _by_doubling(spark: SparkSession, now: DataFrame, kind: str) -> DataFrame:
    """Exact vectors where no chunk converges: cost matrices of runs of chunks, twice as long each round."""
    def matrices():
        return lambda records: ((c, g, last, matrix_of(codes)) for c, g, last, codes in records)

    runs = _stored(spark, map_texts(now.select("conv", "g", "last", "codes"), matrices,
                                    kind.split("codes")[0] + "m array<int>"), "conversation-runs")
    distance = 1
    both = F.expr("""transform(sequence(0, 15), i -> array_min(transform(sequence(0, 3),
        k -> m[cast(floor(i / 4) as int) * 4 + k] + other[k * 4 + i % 4])))""")
    while not runs.where("not last").isEmpty():
        joined = _beside(runs, runs, distance, {"other": "m", "ended": "last"}).withColumn(
            "both", F.when(F.col("last") | F.col("other").isNull(), F.col("m")).otherwise(both))
        runs = _stored(spark, joined.select(
            "conv", "g", (F.col("last") | F.coalesce("ended", F.lit(True))).alias("last"),
            F.expr(f"transform(both, c -> least(c - array_min(both), {FAR}))").alias("m")), "conversation-runs")
        distance *= 2
    end = f"array({', '.join(map(str, END))})"
    front = F.expr(f"transform(sequence(0, 3), q -> array_min(transform(sequence(0, 3), r -> m[q * 4 + r] + {end}[r])))")
    fronts = runs.select("conv", "g", front.alias("f")).select(
        "conv", "g", F.expr("transform(f, c -> c - array_min(f))").alias("front"))
    return _beside(now.select("conv", "g", "last"), fronts, 1, {"front": "front"}).select(
        "conv", "g", F.when(F.col("last"), _vector(END)).otherwise(F.col("front")).alias("behind"))


def entered(spark: SparkSession, parts: DataFrame, behind: DataFrame) -> DataFrame:
    """``behind`` and ``state``, in which each chunk is entered, from the maps of the chunks before it."""
    conv = parts.schema["conv"].dataType.simpleString()
    with_costs = _beside(parts.select("conv", "g", "codes"), behind, 0, {"behind": "behind"})

    def maps():
        return lambda records: ((c, g, list(b), [trace(codes, tuple(b), q)[1] for q in range(4)]) for c, g, codes, b in records)

    own = map_texts(with_costs.select("conv", "g", "codes", "behind"), maps, f"conv {conv}, g long, behind array<int>, m array<int>")
    own = _beside(own, parts, -1, {"before": "g"}).select(
        "conv", "g", "behind", F.when(F.col("before").isNull(), F.array_repeat(F.col("m")[START], 4)).otherwise(F.col("m")).alias("m"))
    own = _stored(spark, own, "conversation-maps")
    now, distance = own, 1
    while not now.where("array_max(m) <> array_min(m)").isEmpty():  # a constant map needs no chunk before it
        now = _stored(spark, _beside(now, now, -distance, {"other": "m"}).select(
            "conv", "g", "behind", F.expr("coalesce(transform(other, q -> m[q]), m)").alias("m")), "conversation-maps")
        distance *= 2
    return _beside(now, now, -1, {"other": "m"}).select(
        "conv", "g", "behind", F.coalesce(F.col("other")[0], F.lit(START)).alias("state"))


def edits(spark: SparkSession, messages: DataFrame, passes: int = PASSES, chunk: int = CHUNK) -> DataFrame:
    """The cheapest edits: a row per distinct message with ``letters`` of its first copy (its others are
    deleted), roles inserted in front (``lead``) and at the end (``trail``), and the role it gets
    (``written``, null if deleted)."""
    chunks = chunked(spark, faults(messages), chunk)
    conv = messages.schema["conv"].dataType.simpleString()
    parts = _stored(spark, chunks.where("goes_on").select("conv", "g", "codes"), "conversation-parts")
    solved = entered(spark, parts, costs(spark, parts, passes))
    whole = chunks.where("not goes_on").withColumn("behind", _vector(END)).withColumn("state", F.lit(START)).withColumn("ends", F.lit(True))
    split = _beside(_beside(chunks.where("goes_on"), solved, 0, {"behind": "behind", "state": "state"}), parts, 1, {"next": "g"}).withColumn(
        "ends", F.col("next").isNull()).drop("next")

    def run():
        def rows(records):
            for c, codes, turns, roles, hashes, copies, found, behind, state, ends in records:
                letters, _ = trace(codes, tuple(behind), state)
                for k, own in enumerate(letters):
                    lead = []
                    for _ in own[:-1]:
                        lead.append(WRITES[state])
                        state = NEXT[state]
                    written = None
                    if own[-1] == "K":
                        written, state = roles[k], kept(codes[k], state)
                    elif own[-1] == "R":
                        written, state = WRITES[state], NEXT[state]
                    trail = []
                    if ends and k == len(letters) - 1:
                        while END[state]:
                            trail.append(WRITES[state])
                            state = NEXT[state]
                    yield c, turns[k], roles[k], hashes[k], copies[k], found[k], own, lead, written, trail
        return rows

    columns = ("conv", "codes", "turns", "roles", "hashes", "copies", "faults", "behind", "state", "ends")
    return map_texts(whole.select(*columns).unionByName(split.select(*columns)), run,
                     f"conv {conv}, turn long, role string, hash string, copies long, fault int, letters string, "
                     "lead array<string>, written string, trail array<string>")


def _in_order(messages: DataFrame, found: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Edits, each followed by its text, in the order of each conversation; ``ids`` put a row in front."""
    empty = lambda kind: F.lit(None).cast(kind)
    blank = {"turn": "long", "role": "string", "hash": "string", "copies": "long", "fault": "int", "letters": "string",
             "lead": "array<string>", "written": "string", "trail": "array<string>", "text": "string"}
    rows = found.withColumn("kind", F.lit(1)).withColumn("text", empty("string"))
    texts = messages.select("conv", "turn", "role", _hash(), "text").withColumn("kind", F.lit(2))
    for c, kind in blank.items():
        texts = texts if c in texts.columns else texts.withColumn(c, empty(kind))
    rows = rows.unionByName(texts)
    if ids is not None:
        marks = ids.withColumn("kind", F.lit(0))
        for c, kind in blank.items():
            marks = marks.withColumn(c, empty(kind))
        rows = rows.unionByName(marks)
    return rows.select("conv", "turn", "role", "hash", "kind", "text", "copies", "fault", "letters", "lead", "written", "trail").repartition(
        "conv").sortWithinPartitions("conv", "turn", "role", "hash", "kind")


def _streamed(rows: DataFrame, work, schema: str) -> DataFrame:
    """Apply a generator over all records of a partition, in order."""
    kind = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out, held = to_arrow_schema(kind), [], 0
        for r in work(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))):
            out.append(r)
            held += 64 + sum(len(x) for x in r if isinstance(x, str))
            if held >= 1 << 20:
                yield _batch(out, arrow)
                out, held = [], 0
        if out:
            yield _batch(out, arrow)

    return rows.mapInArrow(run, kind)


def _replayed(records: Iterable[tuple]) -> Iterator[tuple]:
    """(conv, edit record or None, role and text of a repaired message or None) in order."""
    edit, wanted = None, False
    for r in records:
        conv, kind, text = r[0], r[4], r[5]
        if edit is not None and kind < 2:  # the edit before is over: its end comes behind its text
            yield from ((edit[0], None, (role, "")) for role in edit[11])
            edit = None
        if kind == 0:
            yield conv, None, None
        elif kind == 1:
            edit, wanted = r, r[10] is not None
            yield conv, r, None
            yield from ((conv, None, (role, "")) for role in r[9])
        elif wanted:  # further copies of the text are passed over
            wanted = False
            yield conv, None, (edit[10], text)
    if edit is not None:
        yield from ((edit[0], None, (role, "")) for role in edit[11])


def repaired_messages(messages: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv``, ``position`` (from 0), ``role``, ``text``."""
    def work(records):
        now, position = (), 0
        for conv, _, message in _replayed(records):
            if message is not None:
                position = position + 1 if now == (conv,) else 0
                now = (conv,)
                yield conv, position, *message
    conv = messages.schema["conv"].dataType.simpleString()
    return _streamed(_in_order(messages, found, None), work, f"conv {conv}, position long, role string, text string")


class _Summary:
    """Counts, audit and digest of one conversation, message by message."""

    def __init__(self, conv):
        self.conv, self.gaps, self.counts, self.illegal, self.cost = conv, 0, [0] * 4, 0, 0
        self.audit, self.digest, self.first = StringIO(), hashlib.sha256(), True
        self.turn = self.role = None
        self.trail = 0

    def edit(self, r: tuple) -> None:
        _, turn, role, _, _, _, copies, fault, letters, _, _, trail = r
        if turn is not None:
            self.gaps += max(0, turn - self.turn - 1) if self.turn is not None else 0
            self.turn = turn
        own = role[:1]
        self.illegal += (self.role is not None and (self.role, own) not in LEGAL) + copies - 1
        self.role = own
        self.counts[fault] += 1
        self.counts[BLANK if fault == BLANK else DUPLICATE] += copies - 1
        self.cost += sum({"K": 0, "R": 2, "D": 3, "I": 2}[c] for c in letters) + 3 * (copies - 1) + 2 * len(trail)
        self.cost += fault == TRUNCATED and letters[-1] != "D"
        self.audit.write(letters + "D" * (copies - 1) + "I" * len(trail))

    def message(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def row(self) -> tuple:
        return (self.conv, min(self.gaps, (1 << 63) - 1), *self.counts[1:], self.illegal, self.cost,
                self.audit.getvalue(), self.digest.hexdigest())


def summaries(messages: DataFrame, found: DataFrame, ids: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of each conversation in ``ids`` (``conv``, each once) or with messages."""
    def work(records):
        now = None
        for conv, edit, message in _replayed(records):
            if now is None or now.conv != conv:
                if now is not None:
                    yield now.row()
                now = _Summary(conv)
            if edit is not None:
                now.edit(edit)
            elif message is not None:
                now.message(*message)
        if now is not None:
            yield now.row()
    conv = messages.schema["conv"].dataType.simpleString()
    return _streamed(_in_order(messages, found, ids), work,
                     f"conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                     "audit string, repaired_sha256 string")
