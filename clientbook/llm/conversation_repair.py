"""Repair of conversations whose turns do not alternate.

A repaired conversation has the roles ``(s?(ua)+)?``: nothing, or an optional system message and then
user and assistant in turn. Edits are Keep (0), Rerole to user or assistant (2), Delete (3; the only one
for blank and duplicate rows) and Insert of an empty message (2); a truncated row that stays adds 1.

The cheapest edits are a shortest path through a graph of (row, role state). A path's weight is one
integer: its high digits hold the cost, its low digits, WIDTH of them to the base 5, hold the edits'
initials from the first position on (Delete 1, Insert 2, Keep 3, Rerole 4: their ASCII order), with zeros
after the end. The smallest integer is the cheapest path, and of several the one whose initials come
first. The search runs backwards, so putting an edit in front shifts the rest by one digit.

Integers stay short whatever the length: a conversation is cut into blocks of BLOCK rows, and what a
block adds up to is its rows' letters over the cost of going on. That is exact: of two paths over the same
rows neither's letters can begin with the other's (each ends in a row's letter), so ties within a block are
decided inside it.

One task goes through a conversation in the order of its turns; it keeps a few bytes per row, and texts
only one batch at a time. The result, one text of initials and one SHA-256 over all repaired messages per
conversation, is sequential by its nature.

Awkward rows: nulls count as one space (in the role and the text; a null turn sorts first and leaves no
gap). Roles other than by initial s, u or a, and empty ones, cannot be kept. Rows of equal turn are taken
by role, then by the SHA-256 of role and text. Repeated rows are duplicates of the first. A null
conversation id is a conversation of its own. No rows give no rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clientbook.llm.common import table

BLOCK = 64
#: Letters of a block: at most an insertion and an edit per row, and two insertions at the end.
WIDTH = 2 * BLOCK + 2
LETTERS = "\0DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
EMPTY, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
ROLES = (None, None, "user", "assistant")
#: The role an insertion or a new role has after each state.
_NEXT = (USER, USER, ASSISTANT, USER)
FINE, MUST_GO, TRUNCATED = 0, 1, 2
_KINDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

_COST = 5**WIDTH
_FIRST = 5 ** (WIDTH - 1)

#: The column that marks rows which are there for their conversation's id alone.
LOST = "repair_lost"
SPACES = " \t\n\x0b\x0c\r"
NO_FAULT, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
_FATE = {NO_FAULT: FINE, BLANK: MUST_GO, DUPLICATE: MUST_GO, CUT: TRUNCATED}


def _in_front(cost: int, letter: int, rest: int) -> int:
    """The weight of an edit followed by ``rest``: costs add up, letters move one place on."""
    high, low = divmod(rest, _COST)
    return (high + cost) * _COST + letter * _FIRST + low // 5


_AT_END = (0, _in_front(2, INSERT, _in_front(2, INSERT, 0)), _in_front(2, INSERT, 0), 0)


@lru_cache(maxsize=1 << 16)
def _weights(rows: bytes, ends: tuple[int, ...]) -> tuple[int, ...]:
    """Least weight from each state in front of ``rows``; ``ends`` are the weights behind them."""
    best = ends
    for row in reversed(rows):
        kind, fate = divmod(row, 3)
        after = []
        for state in range(4):
            ways = [_in_front(3, DELETE, best[state])]
            if fate != MUST_GO:
                extra = int(fate == TRUNCATED)
                ways.append(_in_front(2 + extra, REROLE, best[_NEXT[state]]))
                if kind == _NEXT[state] or kind == SYSTEM and state == EMPTY:
                    ways.append(_in_front(extra, KEEP, best[kind]))
            after.append(min(ways))
        # Two insertions in a row are never cheapest: without them the roles alternate as well.
        best = tuple(min(after[s], _in_front(2, INSERT, after[_NEXT[s]])) for s in range(4))
    return best


@lru_cache(maxsize=1 << 16)
def _spelled(weight: int) -> str:
    low, found = weight % _COST, []
    for _ in range(WIDTH):
        low, digit = divmod(low, 5)
        found.append(LETTERS[digit])
    return "".join(reversed(found)).rstrip("\0")


def _state_after(rows: bytes, letters: str, state: int) -> int:
    at = 0
    for letter in letters:
        if letter in "IR":
            state = _NEXT[state]
        elif letter == "K":
            state = rows[at] // 3
        at += letter != "I"
    return state


def cheapest(rows: bytes) -> tuple[int, str]:
    """Cost and initials of the cheapest edits; a row is 3 * kind + fate."""
    blocks = [rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)]
    cost, ends, found = 0, _AT_END, []
    for block in reversed(blocks):
        weights = _weights(block, ends)
        found.append(weights)
        costs = [w // _COST for w in weights]
        least = min(costs)
        cost += least
        # Differences to the least keep the integers of long conversations short.
        ends = tuple((c - least) * _COST for c in costs)
    state, audit = EMPTY, []
    for i, block in enumerate(blocks):
        letters = _spelled(found[-1 - i][state])
        audit.append(letters)
        state = _state_after(block, letters, state)
    return cost + ends[EMPTY] // _COST if blocks else 0, "".join(audit)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, repair_lost) after the damage that the id and turn of each row call for.

    Of ``crc32("conv_id:turn") % 20``: 0 loses the row, 1 empties the text, 2 takes its full stops,
    exclamation and question marks, 3 repeats the row, 4 makes it the user's. Lost rows stay, marked, so
    that a conversation without any other row is still known.
    """
    conv, turn = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn"))
    harm = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(harm == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(harm == 1, F.lit(""))
        .when(harm == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        (harm == 0).alias(LOST),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _messages(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost, said): no nulls in role and text; ``said`` tells equal messages."""
    lost = F.col(LOST) if LOST in conversations.columns else F.lit(False)
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), lost.alias("lost"), said.alias("said")
    )


def faults(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, said, lost, initial, fault) without texts, one partition per conversation."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    plain = _messages(conversations).select(
        "conv_id",
        "turn",
        "role",
        "said",
        "lost",
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    again = Window.partitionBy("conv_id", "lost", "said").orderBy(F.col("turn").asc_nulls_first())
    return (
        plain.repartition("conv_id")
        .withColumn("nth", F.row_number().over(again))
        .select(
            "conv_id",
            "turn",
            "role",
            "said",
            "lost",
            F.substring("role", 1, 1).alias("initial"),
            F.when(F.col("blank"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(F.col("cut"), CUT).otherwise(NO_FAULT).alias("fault"),
        )
    )


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of up to 4,096 rows and about ``most`` characters."""
    kept, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(*kept, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        kept.append(row)
        size += sum(len(value) for value in row if isinstance(value, str))
        if len(kept) == 4096 or size > most:
            yield batch()
            kept, size = [], 0
    if kept:
        yield batch()


def _report(messages: Iterator[tuple]) -> tuple:
    """Counts, cost and initials of one conversation from its rows in order."""
    codes, seen, before, pairs = bytearray(), [0, 0, 0, 0], None, 0
    first = last = None
    turns = 0
    for _, turn, initial, fault, lost in messages:
        if lost:
            continue
        if turn is not None and turn != last:
            first, last, turns = turn if first is None else first, turn, turns + 1
        seen[fault] += 1
        pairs += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        codes.append(3 * _KINDS.get(initial, 0) + _FATE[fault])
    cost, audit = cheapest(bytes(codes))
    gaps = last - first + 1 - turns if turns else 0
    return gaps, seen[BLANK], seen[DUPLICATE], seen[CUT], pairs, cost, audit


def reports(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation.

    ``conversations`` has conv_id, turn, role and text; with a boolean column ``repair_lost`` marked
    rows count for nothing but the conversation's being there.
    """
    schema = T.StructType(
        [conversations.schema["conv_id"], *(T.StructField(name, T.LongType()) for name in _COUNTS), T.StructField("audit", T.StringType())]
    )
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = groupby(_rows(batches), itemgetter(0))
        yield from _batches(((conv, *_report(rows)) for conv, rows in found), arrow)

    ordered = faults(conversations).sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "said"
    )
    return ordered.select("conv_id", "turn", "initial", "fault", "lost").mapInArrow(each, schema)


def _repaired(audit: str, messages: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired conversation, message by message."""
    at, state = 0, EMPTY

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            at, state = at + 1, _NEXT[state]
            yield "I", ROLES[state], ""

    for role, text in messages:
        yield from inserted()
        letter, at = audit[at], at + 1
        if letter == "R":
            state = _NEXT[state]
            yield "R", ROLES[state], text
        elif letter == "K":
            state = _KINDS[role[0]]
            yield "K", role, text
    yield from inserted()


def _with_texts(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's report and then its messages in order, in one partition.

    The report travels as a row in front, so that a long conversation's initials are there once.
    """
    messages = _messages(conversations).filter("NOT lost")
    counts = F.struct(*_COUNTS)
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("said"), F.col("audit").alias("text"), counts.alias("counts"),
    )
    rows = messages.select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "said", "text", F.lit(None).cast(heads.schema["counts"].dataType).alias("counts")
    )
    return (
        heads.unionByName(rows)
        .repartition("conv_id")
        .sortWithinPartitions(
            F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "said"
        )
        .select("conv_id", "role", "text", "counts")
    )


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, counts, audit, repaired messages) per conversation; messages are read as they are asked for."""
    for conv, rows in groupby(_rows(batches), itemgetter(0)):
        _, _, audit, counts = next(rows)
        yield conv, counts, audit, _repaired(audit, ((role, text) for _, role, text, _ in rows))


def repaired(conversations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text): the messages of the repaired conversations, place from 0."""
    schema = T.StructType(
        [
            conversations.schema["conv_id"],
            T.StructField("place", T.LongType()),
            *(T.StructField(name, T.StringType()) for name in ("edit", "role", "text")),
        ]
    )
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((conv, i, *message) for conv, _, _, walk in _walks(batches) for i, message in enumerate(walk))
        yield from _batches(rows, arrow)

    return _with_texts(conversations, reports(conversations) if found is None else found).mapInArrow(each, schema)


def digests(conversations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The reports with ``repaired_sha256``, over the repaired ``role:text`` lines."""
    found = reports(conversations) if found is None else found
    schema = T.StructType([*found.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv, counts, audit, walk in _walks(batches):
                digest, between = hashlib.sha256(), b""
                for _, role, text in walk:
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
                yield conv, *(counts[name] for name in _COUNTS), audit, digest.hexdigest()

        yield from _batches(rows(), arrow)

    return _with_texts(conversations, found).mapInArrow(each, schema)


def query(spark, folder: str) -> DataFrame:
    """Report and digest of each conversation of the table after the damage of :func:`damaged`."""
    return digests(damaged(table(spark, folder, "conversations")))


def _step(state: int) -> str:
    """SQL for the least (cost, audit, repaired) that leads over the current row into a state."""
    ways = []
    for before in range(4):
        now = f"e{before}"
        # Straight to the row, or first an inserted message.
        starts = [(before, 0, "", "")]
        turn = _NEXT[before]
        starts.append((turn, 2, "I", ROLES[turn]))
        for at, cost, letters, insert in starts:
            line = f"{now}.r || [{insert!r} || ':']" if insert else f"{now}.r"
            if at == state:
                ways.append((f"{now} IS NOT NULL", f"{now}.c + {cost + 3}", f"{now}.a || '{letters}D'", line))
            if state == _NEXT[at]:
                new = f"list_concat({line}, ['{ROLES[state]}:' || text])"
                ways.append((f"{now} IS NOT NULL AND fate <> 'go'", f"{now}.c + {cost + 2} + extra", f"{now}.a || '{letters}R'", new))
            if state == _NEXT[at] or (state == SYSTEM and at == EMPTY):
                kept = f"list_concat({line}, [role || ':' || text])"
                mark = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}[state]
                ways.append((f"{now} IS NOT NULL AND fate <> 'go' AND left(role, 1) = '{mark}'", f"{now}.c + {cost} + extra", f"{now}.a || '{letters}K'", kept))
    options = ", ".join(f"CASE WHEN {w} THEN {{'c': {c}, 'a': {a}, 'r': {r}}} END" for w, c, a, r in ways)
    return f"list_min(list_filter([{options}], lambda o: o IS NOT NULL))"


_SPACE = r"[\x20\x09-\x0D]"
_NONE = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR[]))"
SQL = rf"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END),
      4294967295) % 20 AS harm
  FROM conversations
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE harm <> 0
),
ordered AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    regexp_replace(text, '{_SPACE}+$', '') AS trimmed, lag(left(role, 1)) OVER w || left(role, 1) AS pair
  FROM hurt
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), copy)
),
marked AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault FROM ordered
),
fated AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'go' ELSE 'stay' END AS fate,
    CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS extra FROM marked
),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS e0, {_NONE} AS e1, {_NONE} AS e2, {_NONE} AS e3 FROM ids
  UNION ALL
  SELECT w.conv_id, f.i, {_step(0)}, {_step(1)}, {_step(2)}, {_step(3)}
  FROM walk w JOIN fated f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
),
ended AS (
  SELECT conv_id, list_min(list_filter([e0, e3, CASE WHEN e2 IS NOT NULL THEN
      {{'c': e2.c + 2, 'a': e2.a || 'I', 'r': list_concat(e2.r, ['assistant:'])}} END], lambda o: o IS NOT NULL)) AS won
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, won.c AS cost, won.a AS audit,
  sha256(array_to_string(won.r, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
