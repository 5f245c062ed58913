"""Repair of conversation structure: turns aligned to the alternating grammar ``(s?(ua)+)?``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.prefix import cut_lineage, join_on_keys, prefix

# Costs of the edits, and of a truncated row that stays.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows aligned at a time; longer conversations are aligned block by block.
BLOCK = 32
#: Blocks joined at a time.
FAN = 64
#: What has been written so far: nothing, or a last turn of that role.
STATES = ("", "s", "u", "a")
# Fixed value: all other characters are ink.
_BLANKS = " \t\n\x0b\x0c\r"
# Fixed value: roles that may follow each other.
_LEGAL = ("su", "ua", "au")

#: Cheapest (cost, audit) for each pair of states before and after some rows.
Ways = dict[tuple[str, str], tuple[int, str]]


def target(state: str, length: int, system: bool = False) -> str:
    """The ``length`` letters of the grammar that follow ``state``, a system turn first if asked."""
    turns = "au" if state == "u" else "ua"
    return ("s" * system + turns * length)[:length]


def least_cost(rows: str) -> int:
    """What any edits of ``rows`` cost: forced deletions, and truncated rows whether they stay or go."""
    return sum(DELETE if row == "-" else TRUNCATED if row.isupper() or row == "!" else 0 for row in rows)


def align(rows: str, goal: str, most: int) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits that turn ``rows`` into ``goal``, ties to the least audit.

    A row is its role's letter ("s", "u", "a", or "?" for others), in upper case ("!" for "?")
    if it is truncated, or "-" if it must be deleted. Wagner-Fischer from the end, so that the
    trace runs forward and can take the ASCII-least of equally cheap edits at each step. Cells
    on no path of cost ``most`` or less are left out (Ukkonen's band); None if there is no
    such path.
    """
    n, m = len(rows), len(goal)
    kept = [0]
    for row in rows:
        kept.append(kept[-1] + (row != "-"))
    # beyond what all paths cost, a row or a letter without a partner costs 2 at least
    room = (most - least_cost(rows)) // 2
    costs: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        own, below = costs[i], costs[i + 1] if i < n else {}
        for j in range(min(m, kept[i] + room), max(0, kept[i] - room) - 1, -1):
            if abs(kept[i] - j) + abs(kept[n] - kept[i] - m + j) > room:
                continue
            if i == n and j == m:
                own[j] = 0
                continue
            ends = [cost for _, _, _, cost in _edits(rows, goal, i, j, own, below)]
            if ends:
                own[j] = min(ends)
    total = costs[0].get(0)
    if total is None or total > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        edits = _edits(rows, goal, i, j, costs[i], costs[i + 1] if i < n else {})
        letter, i, j, _ = min(edit for edit in edits if edit[3] == costs[i][j])
        audit.append(letter)
    return total, "".join(audit)


def _edits(rows: str, goal: str, i: int, j: int, own: dict[int, int], below: dict[int, int]) -> list[tuple[str, int, int, int]]:
    """(letter, next row, next letter of the goal, cost to the end) of the edits possible at a cell."""
    out = []
    if j in below:
        out.append(("D", i + 1, j, below[j] + DELETE))
    # only user and assistant turns can be inserted or renamed to
    if j + 1 in own and goal[j] != "s":
        out.append(("I", i, j + 1, own[j + 1] + INSERT))
    if j + 1 in below and rows[i] != "-":
        stay = below[j + 1] + (TRUNCATED if rows[i].isupper() or rows[i] == "!" else 0)
        if rows[i].lower() == goal[j]:
            out.append(("K", i + 1, j + 1, stay))
        elif goal[j] != "s":
            out.append(("R", i + 1, j + 1, stay + RENAME))
    return out


def _goals(live: int, before: str, after: str) -> Iterator[tuple[int, list[str]]]:
    """(distance, targets) by the distance of their length to the number of rows that may stay."""
    if after in ("", "s"):
        fixed = [""] if before == after else ["s"] if (before, after) == ("", "s") else []
        for goal in fixed:
            yield abs(len(goal) - live), [goal]
        return
    away = 0
    while True:
        lengths = sorted({live - away, live + away} - set(range(-away, 0)))
        goals = [target(before, n, system) for n in lengths for system in (False, True)[: 1 + (not before and n > 0)]]
        yield away, [g for g in goals if (g[-1:] or before) == after]
        away += 1


def cheapest(rows: str, before: str, after: str) -> tuple[int, str] | None:
    """The cheapest (cost, audit) over the targets of all feasible lengths between two states.

    Lengths are tried from the number of rows that may stay outwards, until the difference
    alone costs more than the incumbent; equally cheap ones are compared by their audits.
    """
    floor, live = least_cost(rows), sum(row != "-" for row in rows)
    best: tuple[int, str] | None = None
    for away, goals in _goals(live, before, after):
        if best and floor + 2 * away > best[0]:
            break
        for goal in goals:
            found, bound = None, floor + 2 * away + 4
            if best:
                found = align(rows, goal, best[0])
            else:  # no incumbent yet: widen the band until it holds a path
                ceiling = floor + DELETE * len(rows) + INSERT * len(goal)
                while not (found := align(rows, goal, bound)) and bound < ceiling:
                    bound *= 2
            if found and (best is None or found < best):
                best = found
    return best


@lru_cache(maxsize=50_000)
def repair(rows: str) -> tuple[int, str]:
    """The cheapest (cost, audit) for a whole conversation: nothing stays, or the end is an assistant turn."""
    return min(cheapest(rows, "", ""), cheapest(rows, "", "a"))


@lru_cache(maxsize=5_000)
def block_ways(rows: str) -> Ways:
    """The cheapest (cost, audit) over a block for each state before and after it."""
    found = {(a, b): cheapest(rows, a, b) for a in STATES for b in STATES if not a or b}
    return {way: best for way, best in found.items() if best}


def chain(parts: Iterable[Ways]) -> Ways:
    """The cheapest ways over all parts in a row.

    Equally cheap audits between the same states edit the same rows, so none is a proper
    prefix of another, and the least of them stays the least whatever follows.
    """
    ways: Ways = {(s, s): (0, "") for s in STATES}
    for part in parts:
        after: Ways = {}
        for (a, b), (cost, audit) in ways.items():
            for (c, d), (more, rest) in part.items():
                if b == c:
                    way = (cost + more, audit + rest)
                    after[a, d] = min(after.get((a, d), way), way)
        ways = after
    return ways


def _text(column: str) -> Column:
    """A value as text; null is one space."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _fault() -> Column:
    return F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20


def plain(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, order, copy): rows for :func:`audit` and :func:`repaired` as they are.

    Nulls of role and text become one space. ``order`` and ``copy`` sort a conversation's rows: by
    turn, nulls first, and rows of one turn by role and text.
    """
    role, text = _text("role"), _text("text")
    order = F.struct("turn", role, F.left(text, F.lit(32)), F.xxhash64(text))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), order.alias("order"), F.lit(0).alias("copy"))


def damage(turns: DataFrame) -> DataFrame:
    """Rows as :func:`plain` gives them, with faults planted by crc32(``conv_id:turn``) modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user
    turn. Rows are ordered by what they were before.
    """
    rows, fault = plain(turns.where(_fault() != 0)), _fault()
    return rows.withColumns(
        {
            "role": F.when(fault == 4, "user").otherwise(F.col("role")),
            "text": F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
            "copy": F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        }
    )


def audit(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation of ``rows``.

    ``rows`` comes from :func:`plain` or :func:`damage`. A row's first fault counts: blank (no
    ink), duplicate (role and text seen earlier in the conversation) or truncated (the last
    ink is none of ``.!?``). gaps: turn numbers missing between the first and the last (turn
    must be a number); illegal: neighbours other than system-user, user-assistant and
    assistant-user by the roles' first letters. audit: the cheapest edits' initials (Delete,
    Insert, Keep, Rerole).

    Rows without their texts are numbered by range, so that a conversation may be of any
    size; blocks of ``BLOCK`` rows are aligned by themselves between all states of the grammar
    and joined ``FAN`` at a time. Only the audit itself, a byte for each row, is held whole. A
    null conv_id is a conversation; empty texts are blank; an empty table gives no rows; other
    columns are not read.
    """
    ink = F.rtrim(F.col("text"), F.lit(_BLANKS))
    first = F.substring("role", 1, 1)
    thin = rows.select(
        "conv_id",
        "turn",
        "order",
        "copy",
        F.when(first.isin("s", "u", "a"), first).otherwise("?").alias("letter"),
        (ink == "").alias("is_blank"),
        (~F.substring(ink, -1, 1).isin(".", "!", "?")).alias("is_cut"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"),
    )
    placed = prefix(thin, ["conv_id"], ["order", "copy"], totals=True).drop("order", "copy")
    repeated = (
        placed.groupBy("conv_id", "same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    known = join_on_keys(placed, repeated, ["conv_id", "same"], "left").withColumn(
        "fault",
        F.when(F.col("is_blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("is_cut"), "truncated"),
    )
    gone = F.col("fault").isin("blank", "duplicate")
    cut_letter = F.when(F.col("letter") == "?", "!").otherwise(F.upper("letter"))
    known = cut_lineage(
        known.select(
            "conv_id",
            "turn",
            "pos",
            "pos_total",
            "letter",
            "fault",
            F.when(gone, "-").when(F.col("fault") == "truncated", cut_letter).otherwise(F.col("letter")).alias("code"),
        )
    )

    faults = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    by_turn = known.groupBy("conv_id", "turn").agg(*faults)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint")
    counts = by_turn.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])

    # the last row of a block shows its letter to the next block too, for the pair they form
    home = F.floor((F.col("pos") - 1) / BLOCK)
    seen_by = F.when((F.col("pos") % BLOCK == 0) & (F.col("pos") < F.col("pos_total")), F.array(home, home + 1)).otherwise(F.array(home))
    spread = known.withColumn("block", F.explode(seen_by)).withColumn("code", F.when(F.col("block") == home, F.col("code")).otherwise(""))
    inside = F.sort_array(F.collect_list(F.struct("pos", "code", "letter")))  # BLOCK + 1 rows at most
    blocks = spread.groupBy("conv_id", "block").agg(inside.alias("rows"), F.max(F.col("pos_total") > BLOCK).alias("long"))
    letters = F.array_join(F.col("rows.letter"), "")
    blocks = blocks.select("conv_id", "block", "long", F.array_join(F.col("rows.code"), "").alias("codes"), letters.alias("letters"))
    solved = cut_lineage(_map(blocks, _solve, "illegal bigint, cost bigint, audit string, ways array<struct<a:string,b:string,cost:bigint,audit:string>>"))

    illegal = solved.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    short = solved.where("ways is null").select("conv_id", "cost", "audit")
    joined = _joined(solved.where("ways is not null").select("conv_id", "block", "ways"))
    found = join_on_keys(illegal, short.unionByName(joined), ["conv_id"])
    return join_on_keys(counts, found, ["conv_id"]).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _map(rows: DataFrame, change, added: str) -> DataFrame:
    """conv_id and block of each row with what ``change`` makes of the row."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [change(row) for row in batch.to_pylist()]
            fields = [pa.array([row[name] for row in made], kind_) for name, kind_ in _ARROW.items() if name in names]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), *fields], ["conv_id", "block", *names])

    names = [part.split(" ")[0] for part in added.replace(", ", "\n").split("\n")]
    return rows.mapInArrow(run, f"conv_id {kind}, block bigint, {added}")


_ARROW = {
    "illegal": pa.int64(),
    "cost": pa.int64(),
    "audit": pa.string(),
    "ways": pa.list_(pa.struct([("a", pa.string()), ("b", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])),
}


def _solve(row: dict) -> dict:
    letters = row["letters"]
    illegal = sum(letters[i : i + 2] not in _LEGAL for i in range(len(letters) - 1))
    if row["long"]:
        return {"illegal": illegal, "cost": None, "audit": None, "ways": _listed(block_ways(row["codes"]))}
    cost, edits = repair(row["codes"])
    return {"illegal": illegal, "cost": cost, "audit": edits, "ways": None}


def _listed(ways: Ways) -> list[dict]:
    return [{"a": a, "b": b, "cost": cost, "audit": edits} for (a, b), (cost, edits) in ways.items()]


def _chained(row: dict) -> Ways:
    return chain({(w["a"], w["b"]): (w["cost"], w["audit"]) for w in part["ways"]} for part in row["parts"])


def _join_some(row: dict) -> dict:
    return {"ways": _listed(_chained(row))}


def _join_last(row: dict) -> dict:
    ways = _chained(row)
    cost, edits = min(ways["", end] for end in ("", "a") if ("", end) in ways)
    return {"cost": cost, "audit": edits}


def _joined(blocks: DataFrame) -> DataFrame:
    """(conv_id, cost, audit) of conversations of several blocks, ``FAN`` blocks at a time."""

    def grouped(by: Column) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct("block", "ways")))  # FAN at most
        return blocks.groupBy("conv_id", by.alias("block")).agg(parts.alias("parts"))

    last = blocks.agg(F.max("block")).first()[0] or 0
    while last >= FAN:
        ways = "ways array<struct<a:string,b:string,cost:bigint,audit:string>>"
        blocks = cut_lineage(_map(grouped(F.floor(F.col("block") / FAN)), _join_some, ways))
        last //= FAN
    return _map(grouped(F.lit(0).cast("bigint")), _join_last, "cost bigint, audit string").drop("block")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, role, text, edit): the repaired turns of each conversation, one behind the other.

    ``rows`` is what the ``audits`` of :func:`audit` were made from. Renamed and inserted turns are
    called user or assistant, inserted ones are empty. The rows of a conversation lie in one
    partition in their order and stream past its audit, so that a task holds one text at a time.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    texts = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "order", "copy", "role", "text")
    order = rows.schema["order"].dataType.simpleString()
    no_text = [F.lit(None).cast(order).alias("order"), F.lit(None).cast("int").alias("copy")]
    no_text += [F.lit(None).cast("string").alias(c) for c in ("role", "text")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # audits have no order, so that they come before the rows
    both = texts.unionByName(audits.select("conv_id", "audit", *no_text)).repartition(parts, "conv_id")
    sorted_ = both.sortWithinPartitions("conv_id", "order", "copy").select("conv_id", "audit", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, system, at, done = "", 0, 0, 0
        for batch in batches:
            out: list[tuple] = []
            for conv_id, own, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is not None:
                    edits, at, done = own, 0, 0
                    system = (len(own) - own.count("D")) % 2  # an odd number of turns begins with a system turn
                else:
                    edit = edits[at]
                    at += 1
                    if edit != "D":
                        out.append((conv_id, role if edit == "K" else _role(done, system), text, edit))
                        done += 1
                while edits[at : at + 1] == "I":
                    out.append((conv_id, _role(done, system), "", "I"))
                    at, done = at + 1, done + 1
            columns = list(zip(*out, strict=True)) or [()] * 4
            fields = [pa.array(columns[0], batch.schema.field("conv_id").type), *(pa.array(c, pa.string()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(fields, ["conv_id", "role", "text", "edit"])

    return sorted_.mapInArrow(run, f"conv_id {kind}, role string, text string, edit string")


def _role(number: int, system: int) -> str:
    """The role of a repaired conversation's turn ``number``."""
    return "user" if (number - system) % 2 == 0 else "assistant"


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the lines ``role:text`` of :func:`repaired`, joined by newlines.

    A digest is one sequence of steps, so a conversation's lines pass one task, row by row.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, type_ = None, None, pa.null()
        for batch in batches:
            type_, ids, hexes = batch.schema.field("conv_id").type, [], []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                line = f"{role}:{text}".encode()
                if digest is not None and conv_id == now:
                    digest.update(b"\n" + line)
                    continue
                if digest is not None:
                    ids.append(now)
                    hexes.append(digest.hexdigest())
                now, digest = conv_id, hashlib.sha256(line)
            yield pa.RecordBatch.from_arrays([pa.array(ids, type_), pa.array(hexes, pa.string())], ["conv_id", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], type_), pa.array([digest.hexdigest()])], ["conv_id", "sha256"])

    return turns.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, sha256 string")


def report(turns: DataFrame) -> DataFrame:
    """Damage, audit and repair of all conversations, one row for each conv_id of ``turns``.

    Columns of :func:`audit` and repaired_sha256. A conversation of which no row is left has
    zeros, an empty audit and the digest of nothing.
    """
    rows = damage(turns)
    audits = cut_lineage(audit(rows))
    told = join_on_keys(audits, digests(repaired(rows, audits)), ["conv_id"], "left")
    told = join_on_keys(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_rows")), told, ["conv_id"], "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return told.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
