"""Repair of conversation structure: cheapest edits by dynamic programming, ties by prefix-doubling path ranking.

A conversation is to read, by the initials of its roles, ``(s?(ua)+)?``: an optional system row, then pairs of user and
assistant. Rows may be kept (cost 0), given another role (3), deleted (4) or inserted with an empty text (3); a blank row or
one whose role and text were seen earlier must go, a truncated row that stays costs 3 more. The audit is the string of the
edits' initials in order; of the cheapest edits those with the ASCII-least audit are taken.

Rows are ordered, counted and cut into chunks by Spark; a chunk is a byte per row. The cost to go is computed over the bytes
of a conversation, backwards. Then the arcs of its optimal paths are ranked by the audit's next letter, the next 2, 4, 8 and so
on: the rank of twice the length follows from an arc's rank and that of the arc its pointer names, and pointers double along.
Each letter leads from a state to one state only, so equal words end at one place and the least word has one path. The start
takes the arc of the least rank and the doubled pointers give the whole path at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import map_batches, materialize

BLANKS = " \t\n\x0b\x0c\r"
USER, ASSISTANT = "user", "assistant"
CHANGE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Distinct rows in a chunk, and rows whose paths are ranked together.
CHUNK_ROWS, BLOCK_ROWS = 1024, 1 << 14

# States of the grammar: nothing yet, behind s, behind u, behind a. All but "behind u" go on with u.
START, SYSTEM, ASKED, ANSWERED = range(4)
NEXT = np.array([ASKED, ASKED, ANSWERED, ASKED])
# Codes of a row: three times its initial (s, u, a, other) plus its fault.
CLEAN, CUT, GONE = range(3)


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by ``crc32(conv_id:turn) % 20``; null roles and texts become one space.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes
    it a user's.
    """
    name = F.concat(*[F.coalesce(c, F.lit(" ")) for c in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    fault = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    spoilt = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, USER).otherwise(role).alias("role"), spoilt.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_"),
    ).drop("_")


def _counted(stored: DataFrame) -> DataFrame:
    """Each different row once with its number, whether it was said in an earlier turn, and its faults; texts by digest."""
    text = F.rtrim("text", F.lit(BLANKS))
    small = stored.select(
        "row_id", "conv_id", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        (text == "").alias("blank"), (~F.right(text, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    rows = small.groupBy("conv_id", "turn", "role", "digest").agg(
        F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")
    )
    said = ["conv_id", "role", "digest"]
    # A struct with a null compares below those without, as null turns come first.
    firsts = rows.groupBy(*said).agg(F.min(F.struct("turn")).alias("first"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in said]
    joined = rows.alias("r").join(firsts.alias("f"), same[0] & same[1] & same[2])
    return joined.select("r.*", (~F.col("f.first.turn").eqNullSafe(F.col("r.turn"))).alias("again"))


def _kind() -> Column:
    initial = F.substr("role", F.lit(1), F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(F.col("blank") | F.col("again"), GONE).when(F.col("cut"), CUT).otherwise(CLEAN)
    return (place * 3 + fault).cast("int")


def _chunks(counted: DataFrame) -> DataFrame:
    """Rows in order, up to ``CHUNK_ROWS`` of a conversation per chunk. A conversation's chunks are numbered upwards."""
    columns = ["conv_id", "kind", "n", "row_id", "role"]
    ordered = counted.withColumn("kind", _kind()).orderBy("conv_id", "turn", "role", "digest").select(*columns)
    conv_type = pa.int64() if isinstance(counted.schema["conv_id"].dataType, T.LongType) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        chunk = TaskContext.get().partitionId() << 33
        open_: list[tuple] = []

        def closed() -> list:
            nonlocal chunk, open_
            conv, kinds, counts, ids, roles = zip(*open_, strict=True)
            open_, chunk = [], chunk + 1
            return [
                pa.array(conv[:1], conv_type), pa.array([chunk - 1], pa.int64()), pa.array([bytes(kinds)], pa.binary()),
                pa.array([counts], pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64())), pa.array([roles], pa.list_(pa.string())),
            ]

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if open_ and (row[0] != open_[0][0] or len(open_) == CHUNK_ROWS):
                    yield closed()
                open_.append(row)
        if open_:
            yield closed()

    schema = T.StructType([T.StructField("conv_id", counted.schema["conv_id"].dataType)]).add("chunk", "long").add("kinds", "binary")
    schema = schema.add("counts", T.ArrayType(T.LongType())).add("row_ids", T.ArrayType(T.LongType())).add("roles", T.ArrayType(T.StringType()))
    return map_batches(ordered, run, schema)


def costs_to_go(kinds: np.ndarray, end: list[int] | None) -> np.ndarray:
    """Least cost from each state before each row, and behind the last, where it is ``end`` if rows follow."""
    out = np.empty((len(kinds) + 1, 4), dtype=np.int64)
    start, system, asked, answered = end or (0, 2 * INSERT, INSERT, 0)
    out[-1] = start, system, asked, answered
    for i in range(len(kinds) - 1, -1, -1):
        initial, fault = divmod(int(kinds[i]), 3)
        a, b, c, d = start + DELETE, system + DELETE, asked + DELETE, answered + DELETE
        if fault != GONE:
            stays = TRUNCATED if fault == CUT else 0
            to_asked, to_answered = asked + stays, answered + stays
            to_asked += 0 if initial == 1 else CHANGE
            to_answered += 0 if initial == 2 else CHANGE
            a, b, c, d = min(a, to_asked), min(b, to_asked), min(c, to_answered), min(d, to_asked)
            if initial == 0:
                a = min(a, system + stays)
        asked, answered = min(c, d + INSERT), min(d, c + INSERT)
        start, system = min(a, asked + INSERT), min(b, asked + INSERT)
        out[i] = start, system, asked, answered
    return out


def least_paths(
    blocks: list[tuple[np.ndarray, np.ndarray, int, bool]],
) -> list[tuple[bytes, np.ndarray, int]]:
    """The least audit through each block: its letters, the state before each, and the state behind the last.

    A block is the codes of rows, their costs to go, the state it starts in and whether it ends its conversation.
    """
    sizes = np.array([len(k) + 1 for k, _, _, _ in blocks])
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    initial, fault = np.full(total, -1), np.full(total, GONE)
    may_insert, is_row = np.ones(total, dtype=bool), np.ones(total, dtype=bool)
    for (kinds, _, _, last), end in zip(blocks, ends, strict=True):
        at = slice(end - len(kinds) - 1, end - 1)
        initial[at], fault[at] = np.divmod(kinds.astype(np.int64), 3)
        is_row[end - 1] = False
        may_insert[end - 1] = last
    togo = np.concatenate([c for _, c, _, _ in blocks]).ravel()

    # Every optimal arc: it starts at a node (row, state), has a letter and ends at a node.
    node = np.arange(total * 4)
    row, state = node // 4, node % 4
    stays = np.where(fault == CUT, TRUNCATED, 0)[row]
    goes_on, follows = is_row[row], NEXT[state]
    kept_to = np.where((initial[row] == 0) & (state == START), SYSTEM, follows)
    fits = np.where(initial[row] == 0, state == START, initial[row] == np.where(follows == ASKED, 1, 2))
    arcs = []
    for letter, allowed, target, cost in (
        (b"D", goes_on, node + 4, DELETE),
        (b"I", may_insert[row], row * 4 + follows, INSERT),
        (b"K", goes_on & (fault[row] != GONE) & fits, (row + 1) * 4 + kept_to, stays),
        (b"R", goes_on & (fault[row] != GONE), (row + 1) * 4 + follows, CHANGE + stays),
    ):
        reached = np.where(allowed, target, node)
        best = allowed & (togo == togo[reached] + cost)
        arcs.append((node[best], np.full(int(best.sum()), letter[0]), reached[best]))
    source, letter, target = (np.concatenate(part) for part in zip(*arcs, strict=True))

    # Level 0: an arc's rank is its letter, its pointer the least arc of the node where it ends. The last item ends a path.
    done = len(source)
    least = np.full(total * 4, done)
    for i in range(len(arcs) - 1, -1, -1):  # D over I over K over R
        begin = sum(len(a[0]) for a in arcs[:i])
        least[arcs[i][0]] = np.arange(begin, begin + len(arcs[i][0]))
    rank, pointer = np.append(letter, 0).astype(np.int64), np.append(least[target], done)
    length = np.append(np.ones(done, dtype=np.int64), 0)
    doubled = [pointer]
    while (pointer != done).any():
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        length = length + length[pointer]
        pointer = pointer[pointer]
        doubled.append(pointer)

    starts = (ends - sizes) * 4 + np.array([s for _, _, s, _ in blocks])
    by_rank = np.lexsort((rank[:done], source))
    first = np.searchsorted(source[by_rank], starts)
    has = (first < done) & (source[by_rank[np.minimum(first, done - 1)]] == starts) if done else np.zeros(len(starts), dtype=bool)
    begin = np.where(has, by_rank[np.minimum(first, done - 1)] if done else done, done)
    lengths = length[begin]
    item = np.repeat(begin, lengths)
    step = np.arange(len(item)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    for level, pointers in enumerate(doubled):
        on = (step >> level) & 1 == 1
        item[on] = pointers[item[on]]
    out, at = [], 0
    for (_, _, entry, _), size in zip(blocks, lengths.tolist(), strict=True):
        path = item[at : at + size]
        out.append((letter[path].astype(np.uint8).tobytes(), source[path] % 4, int(target[path[-1]] % 4) if size else entry))
        at += size
    return out


def repair_codes(conversations: list[np.ndarray]) -> list[tuple[int, bytes, np.ndarray]]:
    """Cost, audit and the state before each letter for conversations given by the codes of their rows.

    Paths are ranked block by block, so memory holds one block of a long conversation besides its codes.
    """
    cuts = [range(0, max(len(k), 1), BLOCK_ROWS) for k in conversations]
    ends: list[dict[int, list[int] | None]] = []
    cost = []
    for kinds, starts in zip(conversations, cuts, strict=True):
        behind, after = {}, None
        for start in reversed(starts):
            behind[start] = after
            after = costs_to_go(kinds[start : start + BLOCK_ROWS], after)[0].tolist()
        ends.append(behind)
        cost.append(after[START])
    state = [START] * len(conversations)
    letters: list[list[bytes]] = [[] for _ in conversations]
    states: list[list[np.ndarray]] = [[] for _ in conversations]
    for wave in range(max(map(len, cuts), default=0)):
        alive = [i for i, c in enumerate(cuts) if wave < len(c)]
        blocks = []
        for i in alive:
            start = cuts[i][wave]
            part = conversations[i][start : start + BLOCK_ROWS]
            blocks.append((part, costs_to_go(part, ends[i][start]), state[i], wave + 1 == len(cuts[i])))
        for i, (word, before, after) in zip(alive, least_paths(blocks), strict=True):
            letters[i].append(word)
            states[i].append(before)
            state[i] = after
    return [(c, b"".join(w), np.concatenate(s)) for c, w, s in zip(cost, letters, states, strict=True)]


def _illegal(kinds: np.ndarray) -> int:
    pairs = (kinds[:-1] // 3) * 4 + kinds[1:] // 3
    return int((~np.isin(pairs, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])).sum())


def _audits(chunks: DataFrame) -> DataFrame:
    """Per conversation: illegal neighbours, cost, audit, and the audit's piece for each chunk with the state before it."""
    coded = F.struct("chunk", "kinds", "counts")
    gathered = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(coded)).alias("chunks"))
    piece = T.StructType().add("chunk", "long").add("state", "integer").add("letters", "string")
    arrow_piece = pa.struct([("chunk", pa.int64()), ("state", pa.int32()), ("letters", pa.string())])

    def codes(parts: list[dict]) -> tuple[np.ndarray, list[int]]:
        """A code for every row, copies of a row being further ones that must go, and where each chunk ends."""
        kinds = np.frombuffer(b"".join(p["kinds"] for p in parts), dtype=np.uint8).astype(np.int16)
        counts = np.concatenate([p["counts"] for p in parts]).astype(np.int64)
        every = np.repeat(kinds // 3 * 3 + GONE, counts)
        every[np.cumsum(counts) - counts] = kinds
        rows = np.add.reduceat(counts, np.cumsum([0, *[len(p["kinds"]) for p in parts[:-1]]]))
        return every, np.cumsum(rows).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                gathered = batch.column(1).to_pylist()
                coded = [codes(parts) for parts in gathered]
                fixed = repair_codes([kinds for kinds, _ in coded])
                pieces = []
                for parts, (_, row_ends), (_, word, states) in zip(gathered, coded, fixed, strict=True):
                    # Each letter but I uses up a row; what is inserted behind the last row goes with its chunk.
                    used = np.flatnonzero(np.frombuffer(word, dtype=np.uint8) != ord("I"))
                    cut = [0, *[int(used[e - 1]) + 1 for e in row_ends[:-1]], len(word)]
                    pieces.append([
                        {"chunk": p["chunk"], "state": int(states[a]), "letters": word[a:b].decode()}
                        for p, a, b in zip(parts, cut, cut[1:], strict=False)
                    ])
                yield [
                    batch.column(0), pa.array([_illegal(k) for k, _ in coded], pa.int64()),
                    pa.array([c for c, _, _ in fixed], pa.int64()), pa.array([w.decode() for _, w, _ in fixed]),
                    pa.array(pieces, pa.list_(arrow_piece)),
                ]

    schema = T.StructType([chunks.schema["conv_id"]]).add("illegal", "long").add("cost", "long").add("audit", "string")
    return map_batches(gathered, run, schema.add("pieces", T.ArrayType(piece)))


def _edited(chunks: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows after the edits: ``conv_id, chunk, place, role, row_id``; inserted ones have no ``row_id``."""
    pieces = audits.select(F.inline("pieces"))
    rows = chunks.drop("kinds").join(pieces, "chunk").select("conv_id", "chunk", "counts", "row_ids", "roles", "state", "letters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            taken, chunk, place, roles, ids = [], [], [], [], []
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for i, (number, counts, row_ids, names, state, letters) in enumerate(zip(*columns, strict=True)):
                at, copies = 0, 0
                for p, letter in enumerate(letters):
                    if letter != "D":
                        kept = letter == "K"
                        if kept and names[at].startswith("s"):
                            state, role = SYSTEM, names[at]
                        else:
                            state = ANSWERED if state == ASKED else ASKED
                            role = names[at] if kept else (USER if state == ASKED else ASSISTANT)
                        taken.append(i)
                        chunk.append(number)
                        place.append(p)
                        roles.append(role)
                        ids.append(None if letter == "I" else row_ids[at])
                    if letter != "I":
                        copies += 1
                        if copies == counts[at]:
                            at, copies = at + 1, 0
            yield [
                batch.column(0).take(pa.array(taken, pa.int64())), pa.array(chunk, pa.int64()), pa.array(place, pa.int32()),
                pa.array(roles, pa.string()), pa.array(ids, pa.int64()),
            ]

    schema = T.StructType([chunks.schema["conv_id"]]).add("chunk", "long").add("place", "integer").add("role", "string")
    return map_batches(rows, run, schema.add("row_id", "long"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts of each conversation of ``rows`` (``conv_id, turn, role, text``), and its rows as repaired.

    The first frame is ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, the second ``conv_id, chunk,
    place, role, text``, to be read in the order of chunk and place. Rows stand in the order of turn, null first, and within
    a turn in that of role and the text's SHA-256; a null role or text is one space; rows without ``conv_id`` are one
    conversation. Other columns are left out; an empty table gives none. A role that begins with none of s, u, a (the empty
    one included) can't be kept.

    Texts stay where they are stored until the edits are known; order and edits work on digests and codes. Equal rows of a
    turn are counted before they are exchanged, a long conversation is sorted across tasks, and only its codes and its audit,
    a few bytes a row, come together in one.
    """
    filled = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    stored = materialize(filled.withColumn("row_id", F.monotonically_increasing_id()), "repair-rows")
    counted = materialize(_counted(stored), "repair-counted")
    chunks = materialize(_chunks(counted), "repair-chunks")
    audits = materialize(_audits(chunks), "repair-audits")

    stays = ~F.col("blank") & ~F.col("again")
    facts = counted.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("again"), F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.count_if(stays & F.col("cut")).alias("truncated"),
    )
    same = F.col("f.conv_id").eqNullSafe(F.col("a.conv_id"))
    report = facts.alias("f").join(audits.alias("a"), same).select("f.*", "a.illegal", "a.cost", "a.audit")

    edited = _edited(chunks, audits)
    order = ["conv_id", "chunk", "place", "role"]
    texts = edited.filter("row_id IS NOT NULL").join(stored.select("row_id", "text"), "row_id").select(*order, "text")
    added = edited.filter("row_id IS NULL").select(*order, F.lit("").alias("text"))
    return report, texts.union(added)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id`` and the SHA-256 of its rows as ``role:text``, joined by line ends. A task reads its rows one by one."""
    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "place")
    lines = ordered.select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        digest, now = None, None
        for batch in batches:
            conv, found = [], []
            for here, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest is None or here != now:
                    if digest is not None:
                        conv.append(now)
                        found.append(digest.hexdigest())
                    digest, now = hashlib.sha256(), here
                else:
                    digest.update(b"\n")
                digest.update(line.encode())
            yield [pa.array(conv, batch.column(0).type), pa.array(found, pa.string())]
            kind = batch.column(0).type
        if digest is not None:
            yield [pa.array([now], kind), pa.array([digest.hexdigest()])]

    return map_batches(lines, run, T.StructType([repaired.schema["conv_id"]]).add("sha256", "string"))
