"""Repair of conversation structure: cheapest edits to a legal order of roles, by Hirschberg's method."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import numbered, pick, stored

#: The legal orders of roles, `(s?(ua)+)?`, as states and what leads on.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (START, ASSISTANT)
#: The role that a rerole or an insertion gives in each state.
GIVEN = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
NAMES = {"u": "user", "a": "assistant"}
#: Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: A row's kind is its role's initial (o: any other), by whether it is whole, truncated, or has to go.
INITIALS, CUT, GONE = "suao", "SUAO", "1234"
LEGAL = {"su", "ua", "au"}
#: Rows of a conversation that one task repairs at once.
SEGMENT = 4096
INFINITE = 1 << 62
BLANKS = " \t\n\x0b\x0c\r"
#: The columns that tell a conversation, and the order of its rows.
CONVERSATION = ["named", "conv"]
ORDER = ["turn", "role", "h1", "h2", "copy"]

#: From each state to each state: cost and a key that orders the audits with that cost.
Step = tuple[tuple[tuple[int, object], ...], ...]


def edits(kind: str) -> Iterator[tuple[int, int, int, str]]:
    """`before, after, cost, audit` of each way to pass a row of this kind (empty: the end)."""
    for before in range(4):
        state, cost, audit = before, 0, ""
        for _ in range(3):  # more insertions come back to a state that was there
            if not kind:
                yield before, state, cost, audit
            else:
                yield before, state, cost + DELETE, audit + "D"
                if kind not in GONE:
                    cut = TRUNCATED if kind in CUT else 0
                    after = NEXT.get((state, kind.lower()))
                    if after is not None:
                        yield before, after, cost + KEEP + cut, audit + "K"
                    yield before, NEXT[state, GIVEN[state]], cost + REROLE + cut, audit + "R"
            state, cost, audit = NEXT[state, GIVEN[state]], cost + INSERT, audit + "I"


def cheapest(kind: str) -> Step:
    """The cheapest, then ASCII-least way from each state to each state."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before, after, cost, audit in edits(kind):
        best[before, after] = min(best.get((before, after), (INFINITE, "")), (cost, audit))
    return tuple(tuple(best.get((p, q), (INFINITE, "")) for q in range(4)) for p in range(4))


#: The step of each kind, and of the end.
STEPS = {kind: cheapest(kind) for kind in ("", *INITIALS, *CUT, *GONE)}


def step(kind: str) -> Step:
    return STEPS[kind]


def forward(steps: list[Step], enter: int) -> list[tuple[int, int]]:
    """Cost and rank for each state behind the steps; ranks order the least audits with these costs.

    Audits that end at the same row are never the beginning of one another, since insertions
    belong to the row that follows: the order of two is settled where they first differ. So the
    rank before a step, then the step's own key, order the audits behind it.
    """
    vector = [(0 if p == enter else INFINITE, 0) for p in range(4)]
    for matrix in steps:
        reached = []
        for q in range(4):
            ways = [(cost + matrix[p][q][0], rank, matrix[p][q][1]) for p, (cost, rank) in enumerate(vector) if cost < INFINITE and matrix[p][q][0] < INFINITE]
            reached.append(min(ways) if ways else None)
        ranks = {key: i for i, key in enumerate(sorted({way[1:] for way in reached if way}))}
        vector = [(way[0], ranks[way[1:]]) if way else (INFINITE, 0) for way in reached]
    return vector


def backward(steps: list[Step], leave: int) -> list[int]:
    """The cost from each state before the steps to the one behind them."""
    vector = [0 if q == leave else INFINITE for q in range(4)]
    for matrix in reversed(steps):
        vector = [min(INFINITE, *(matrix[p][q][0] + vector[q] for q in range(4))) for p in range(4)]
    return vector


def crossings(steps: list[Step], enter: int, leave: int) -> list[int]:
    """The states before, between and behind the steps on the cheapest, ASCII-least way.

    Forward and backward vectors meet in the middle; of the crossings with the least sum the one
    of the least rank is on the way. Both halves go on by themselves.
    """
    states = [enter] * len(steps) + [leave]
    open_parts = [(0, len(steps))]
    while open_parts:
        low, high = open_parts.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        ahead = forward(steps[low:middle], states[low])
        behind = backward(steps[middle:high], states[high])
        states[middle] = min(range(4), key=lambda q: (ahead[q][0] + behind[q], ahead[q][1]))
        open_parts += [(low, middle), (middle, high)]
    return states


def best_end(steps: list[Step]) -> tuple[int, int]:
    """The cost of the cheapest way from the start, and the final state of the least such audit."""
    vector = forward(steps, START)
    cost, _, state = min((*vector[q], q) for q in FINAL)
    return cost, state


def segment_step(kinds: str) -> Step:
    """A run of rows as one step."""
    return tuple(tuple(forward([step(k) for k in kinds], p)) for p in range(4))


def written(steps: list[Step], states: list[int]) -> str:
    return "".join(str(m[p][q][1]) for m, p, q in zip(steps, states, states[1:], strict=False))


#: Conversations of the same kinds have the same audit; at most so many are remembered.
REMEMBERED = 1 << 16
known: dict[str, tuple[int, str]] = {}


def audit_of(kinds: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    if kinds not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        steps = [step(k) for k in kinds] + [step("")]
        cost, end = best_end(steps)
        known[kinds] = cost, written(steps, crossings(steps, START, end))
    return known[kinds]


def segment_audit(kinds: str, enter: int, leave: int) -> str:
    steps = [step(k) for k in kinds]
    return written(steps, crossings(steps, enter, leave))


def initials(kinds: str) -> str:
    return kinds.translate(str.maketrans(CUT + GONE, INITIALS * 2))


def illegal_pairs(kinds: str) -> int:
    roles = initials(kinds)
    return sum(a + b not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows `named, conv, turn, role, text, copy` after the damage that their checksums name.

    Nulls read as one space, in the checksum too; a null turn stays null for the order.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    code = F.crc32(F.encode(F.concat(conv, F.lit(":"), turn), "UTF-8")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.withColumn("code", code)
        .where("code <> 0")
        .select(
            F.col("conv_id").isNotNull().alias("named"),
            F.coalesce("conv_id", F.lit(0).cast("bigint")).alias("conv"),
            "turn",
            F.when(F.col("code") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(copies).alias("copy"),
        )
    )


def with_hashes(rows: DataFrame) -> DataFrame:
    """Two hashes that stand for role and text."""
    return rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "role", "text")})


def kinds_of(rows: DataFrame) -> DataFrame:
    """`named, conv, turn, position, total, blank, duplicate, truncated, kind` of each row; no texts.

    Rows are in the order of their turn (null first), then role, then the hashes of role and
    text; a conversation of any size is dealt out by ranges of that order.
    """
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    narrow = with_hashes(rows).select(
        *CONVERSATION, *ORDER, (~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).alias("blank"), (~end.isin(".", "!", "?")).alias("cut")
    )
    placed = stored(numbered(stored(narrow, "turns"), CONVERSATION, ORDER), "placed-turns")
    earliest = placed.groupBy(*CONVERSATION, "h1", "h2").agg(F.min("position").alias("earliest"))
    marked = placed.join(earliest, [*CONVERSATION, "h1", "h2"])
    duplicate = ~F.col("blank") & (F.col("position") > F.col("earliest"))
    truncated = ~F.col("blank") & ~F.col("duplicate") & F.col("cut")
    number = F.position(F.substring("role", 1, 1), F.lit(INITIALS[:3]))  # 1 for an empty role, too
    number = F.when((number == 0) | (F.col("role") == ""), 4).otherwise(number)
    letters = F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), CUT).otherwise(INITIALS)
    marked = marked.withColumn("duplicate", duplicate).withColumn("truncated", truncated)
    return marked.select(
        *CONVERSATION, "turn", "position", "total", "blank", "duplicate", "truncated", F.substring(letters, number, F.lit(1)).alias("kind")
    )


def repairs(kinds: DataFrame) -> DataFrame:
    """`named, conv, cost, illegal, audit` of each conversation, from its rows' kinds.

    A conversation of at most SEGMENT rows is repaired in one piece. Longer ones are cut: each
    segment becomes one step, the segments' steps give the states between them by the same
    forward and backward meeting, and each segment is then repaired between its two states.
    """
    audit_type = "cost bigint, illegal bigint, audit string"
    parts = kinds.groupBy(*CONVERSATION, F.floor(F.col("position") / SEGMENT).alias("segment"), "total").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "kind"))), lambda r: r["kind"]), "").alias("kinds")
    )
    parts = stored(parts, "segments")
    whole = F.udf(lambda kinds: (audit_of(kinds)[0], illegal_pairs(kinds), audit_of(kinds)[1]), audit_type)
    short = parts.where(F.col("total") <= SEGMENT).select(*CONVERSATION, whole("kinds").alias("r")).select(*CONVERSATION, "r.*")
    long = parts.where(F.col("total") > SEGMENT)
    if long.isEmpty():
        return short

    matrix = F.udf(lambda kinds: [x for row in segment_step(kinds) for entry in row for x in entry], "array<bigint>")
    inside = F.udf(illegal_pairs, "bigint")
    summary = F.struct("segment", matrix("kinds").alias("matrix"), F.left("kinds", F.lit(1)).alias("a"), F.right("kinds", F.lit(1)).alias("b"), inside("kinds").alias("illegal"))
    plan_type = "cost bigint, illegal bigint, tail string, ways array<struct<segment:bigint,enter:int,leave:int>>"

    def planned(segments: list):
        segments = sorted(segments, key=lambda s: s["segment"])
        steps = [
            tuple(tuple((s["matrix"][8 * p + 2 * q], s["matrix"][8 * p + 2 * q + 1]) for q in range(4)) for p in range(4))
            for s in segments
        ] + [step("")]
        cost, end = best_end(steps)
        states = crossings(steps, START, end)
        seams = sum(illegal_pairs(x["b"] + y["a"]) for x, y in zip(segments, segments[1:], strict=False))
        ways = [(s["segment"], states[i], states[i + 1]) for i, s in enumerate(segments)]
        return cost, seams + sum(s["illegal"] for s in segments), written(steps[-1:], states[-2:]), ways

    plans = long.groupBy(*CONVERSATION).agg(F.collect_list(summary).alias("s")).select(*CONVERSATION, F.udf(planned, plan_type)("s").alias("p"))
    plans = stored(plans.select(*CONVERSATION, "p.*"), "segment-plans")
    ways = plans.select(*CONVERSATION, F.inline("ways"))
    piece = F.udf(segment_audit, "string")
    pieces = long.join(ways, [*CONVERSATION, "segment"]).select(*CONVERSATION, "segment", piece("kinds", "enter", "leave").alias("piece"))
    pieces = pieces.groupBy(*CONVERSATION).agg(F.sort_array(F.collect_list(F.struct("segment", "piece"))).alias("pieces"))
    joined = pieces.join(plans, CONVERSATION)
    audit = F.concat(F.array_join(F.transform("pieces", lambda x: x["piece"]), ""), F.col("tail"))
    return short.unionAll(joined.select(*CONVERSATION, "cost", "illegal", audit.alias("audit")))


def reports(kinds: DataFrame) -> DataFrame:
    """`named, conv, gaps, blank, duplicate, truncated, illegal, cost, audit` of each conversation."""
    turns = kinds.groupBy(*CONVERSATION, "turn").agg(*[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    sums = turns.groupBy(*CONVERSATION).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    return sums.join(repairs(kinds), CONVERSATION)


REPORT = {"gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string"}


class Replay:
    """Applies a conversation's audit to its rows, one at a time."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self.given(), ""

    def given(self) -> str:
        role = GIVEN[self.state]
        self.state = NEXT[self.state, role]
        return NAMES[role]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """`edit, role, text` of what stands in the place of a row, insertions before it included."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = NEXT[self.state, role[0]]
            yield edit, role, text
        elif edit == "R":
            yield edit, self.given(), text


def streamed(rows: DataFrame, found: DataFrame, start, take, finish, schema: str) -> DataFrame:
    """Each conversation's rows in order through one task, its report first; texts are exchanged once.

    `start(report)` makes a state, `take(state, edit, role, text, turn)` and `finish(state)` give
    lists of result rows. A task holds one batch of rows, not a conversation.
    """
    texts = with_hashes(rows).select(
        *CONVERSATION, F.lit(1).alias("kind"), *ORDER, "text", *[F.lit(None).cast(t).alias(c) for c, t in REPORT.items()]
    )
    nulls = {"turn": "bigint", "role": "string", "h1": "bigint", "h2": "bigint", "copy": "int", "text": "string"}
    heads = found.select(*CONVERSATION, F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in nulls.items()], *REPORT)
    dealt = heads.unionAll(texts).repartition(*CONVERSATION)
    order = [F.col(c).asc_nulls_first() for c in (*CONVERSATION, "kind", *ORDER)]
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "string": pa.string()}[field.split()[1]] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = state = None

        def ended() -> list:
            if replay is None:
                return []
            last = [x for edit in replay.inserted() for x in take(state, *edit, None)]
            return last + finish(state)

        def as_batch(out: list) -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    out += ended()
                    replay, state = Replay(row["audit"]), start(row)
                else:
                    for edit in replay.row(row["role"], row["text"]):
                        out += take(state, *edit, row["turn"])
            yield as_batch(out)
        yield as_batch(ended())

    return dealt.sortWithinPartitions(*order).mapInArrow(run, schema)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`conv_id, place, edit, turn, role, text` of the repaired conversations; see `repair`."""

    def start(report: dict) -> dict:
        return {"conv": report["conv"] if report["named"] else None, "place": -1}

    def take(state: dict, edit: str, role: str, text: str, turn: int | None) -> list:
        state["place"] += 1
        return [(state["conv"], state["place"], edit, turn if edit != "I" else None, role, text)]

    schema = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"
    return streamed(rows, found, start, take, lambda state: [], schema)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`conv_id`, the report, and `repaired_sha256`, the hash of the repaired `role:text` lines."""

    def start(report: dict) -> dict:
        return {"conv": report["conv"] if report["named"] else None, "report": [report[c] for c in REPORT], "hash": hashlib.sha256(), "lines": 0}

    def take(state: dict, edit: str, role: str, text: str, turn: int | None) -> list:
        state["hash"].update((("\n" if state["lines"] else "") + f"{role}:{text}").encode())
        state["lines"] += 1
        return []

    def finish(state: dict) -> list:
        return [(state["conv"], *state["report"], state["hash"].hexdigest())]

    schema = "conv_id bigint, " + ", ".join(f"{c} {t}" for c, t in REPORT.items()) + ", repaired_sha256 string"
    return streamed(rows, found, start, take, finish, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(turns, digests)` of conversations `named, conv, turn, role, text, copy` (see `damaged`).

    A row's first fault counts: blank (ASCII white space only), duplicate (its role and text stand
    earlier in the conversation), truncated (does not end in `.`, `!` or `?`). Edits keep a row
    (0), give it the role user or assistant (1), delete it (2; blank and duplicate rows have to
    go) or insert an empty row (5); truncated rows that stay cost 5. Of the edits that lead to the
    roles `(s?(ua)+)?` at the least cost, those with the ASCII-least initials (the audit) are
    applied. Roles with other initials can only be changed or deleted.

    `gaps` counts the turn numbers that are missing between the first and the last, `illegal` the
    neighbours before the repair that may not follow each other. Rows of one turn are in the
    order of their role, then of a hash of role and text. Null conversations are one
    conversation. A text is exchanged once, along the conversation's order; the hash of a
    conversation is made in one task, row by row.
    """
    found = stored(reports(kinds_of(rows)), "reports")
    return repaired_turns(rows, found), digests(rows, found)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Digests (see `repair`) of every conversation after damage; those that lost all rows are empty."""
    _, found = repair(damaged(conversations))
    every = pick(conversations, "conv_id").distinct().withColumnRenamed("conv_id", "every")
    joined = every.join(found, F.col("every").eqNullSafe(F.col("conv_id")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    zeros = [F.coalesce(F.col(c), F.lit("") if t == "string" else F.lit(0).cast(t)).alias(c) for c, t in REPORT.items()]
    return joined.select(F.col("every").alias("conv_id"), *zeros, F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
