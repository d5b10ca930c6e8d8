"""Conversation structure repair on a suffix-shared word graph (operator 11).

A conversation is a word over role/fault signatures, one letter for each row.
Repairs are edits of its rows: keep (free), rerole to user or assistant (2),
delete (3; the only choice for blank and duplicate rows), insert an empty row
of user or assistant anywhere (2); a truncated row that stays costs 1.  The
cheapest repair that leaves the roles system?(user assistant)+, or nothing, is
wanted; of equally cheap ones that with the least audit, the string of the
edits' initials.

What a repair costs from some row on depends on the rows that follow, and on
the grammar's state.  So conversations share a graph from their ends: a node is
a different rest of a word, with one edge to the rest without its first letter,
and has a cost-to-go and a best edit for each grammar state.  The best audit
from there is that edit and the best audit of the node and state it leads to;
since different edits have different letters, ties need no look at the rest.
Nodes whose costs differ only by a constant behave alike, so their steps are
looked up by shape.  Spark sorts the words by their reversal, in ranges: that
is a walk through the graph in depth, so each node is made once (again only
where two ranges meet), and a task holds one open path, not the graph.

Order of work: equal rows of a turn fold with a count; the first row of each
role and text is found by an aggregate; ranges of rows in order become pieces
of words, whose concatenation is a conversation's word, so that a conversation
of any length is split over tasks; words in ranges become audits; one pass over
the texts in order applies them.  Only that last pass is one task for each
conversation, since a checksum of its text is sequential; it streams, and holds
no more than a batch and the audit.

Defined results: a null role or text is one space; rows stand by turn (nulls
first), then role, then md5 of length, role and text; a null conv_id is a
conversation of its own; repeated rows are duplicates; an empty table gives an
empty result; other columns pass through unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm.resampling import CRC_SQL
from aeroseries.llm.store import write_table

K.ship_by_value(__name__)
SPACE = " \t\n\x0b\x0c\r"
ROLES = "sua"
OTHER = 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: One letter for each role (system, user, assistant, other) and fault.
LETTERS = "ABCDEFGHIJKLMNOP"
TO_FAULT = str.maketrans({x: str(i % 4) for i, x in enumerate(LETTERS)})
TO_ROLE = str.maketrans({x: (ROLES + "x")[i // 4] for i, x in enumerate(LETTERS)})
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a row of the next role leads to; its role's name.
NEXT = [USER, USER, ASSISTANT, USER]
NAME = {USER: "user", ASSISTANT: "assistant"}
#: The state after a kept row of role 0 (system), 1 (user), 2 (assistant) or 3.
KEPT = [[SYSTEM, USER, None, None], [None, USER, None, None], [None, None, ASSISTANT, None], [None, USER, None, None]]
NEVER = 1 << 40


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults made by a checksum of conversation and turn; ``copies`` is how often each stands there."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.select("conv_id", "turn", "role", "text", F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("d") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), F.coalesce(text, blank).alias("text"), F.when(F.col("d") == 0, 0).when(F.col("d") == 3, 2).otherwise(1).alias("copies"))


def _stated(rows: DataFrame) -> DataFrame:
    """Rows with their key of order and their letter (duplicates aside)."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.col("copies").cast("long").alias("copies"))
    bare = F.expr(r"trim(TRAILING '\u0020\u0009\u000A\u000B\u000C\u000D' FROM text)")
    fault = F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    role = F.lit(OTHER)
    for i, r in enumerate(ROLES):
        role = F.when(F.substring("role", 1, 1) == r, i).otherwise(role)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return rows.select("conv_id", "turn", F.col("turn").isNotNull().alias("has_turn"), "role", digest.alias("digest"), "copies", (4 * role + fault).alias("letter"), "text")


PLACE = ["conv_id", "has_turn", "turn", "role", "digest"]


def _pieces(stated: DataFrame) -> DataFrame:
    """(conv_id, part, seq, word, lo, hi, turns): pieces of every conversation's word in order, and the different turns of each piece."""
    folded = stated.groupBy(*PLACE, "letter").agg(F.sum("copies").alias("copies"))
    first = folded.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("has_turn", "turn")).alias("at"))
    # A mark before the first row of each role and text: no join, and no group in one task.
    marks = first.select("conv_id", "at.has_turn", "at.turn", "role", "digest", F.lit(-1).alias("letter"), F.lit(0).cast("long").alias("copies"))
    rows = folded.select(*PLACE, "letter", "copies").unionByName(marks)
    kind = stated.schema["conv_id"].dataType.simpleString()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, marked = TaskContext.get().partitionId(), 0, False
        for batch in batches:
            convs = batch.column(0)
            out, conv, word, turns = [], None, [], []

            def close() -> None:
                some = [t for t in turns if t is not None]
                out.append((conv, part, seq + len(out), "".join(word), some[0] if some else None, some[-1] if some else None, len(set(some))))

            for n, (conv_id, turn, letter, copies) in enumerate(zip(convs.to_pylist(), *(batch.column(i).to_pylist() for i in (1, 2, 3)))):
                if n and conv_id != conv:
                    close()
                    word, turns = [], []
                conv = conv_id
                if letter < 0:
                    marked = True
                elif copies:
                    again = LETTERS[letter if letter % 4 == BLANK else letter // 4 * 4 + DUPLICATE]
                    word.append((LETTERS[letter] if marked else again) + again * (copies - 1))
                    turns.append(turn)
                    marked = False
            if batch.num_rows:
                close()
                seq += len(out)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), [convs.type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()])], ["conv_id", "part", "seq", "word", "lo", "hi", "turns"])

    ordered = rows.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE, "letter").select("conv_id", "turn", "letter", "copies")
    return ordered.mapInArrow(spell, f"conv_id {kind}, part long, seq long, word string, lo long, hi long, turns long")


def words(stated: DataFrame) -> DataFrame:
    """(conv_id, word, gaps) of every conversation, those without rows included."""
    parts = _pieces(stated).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "seq", "word", "lo", "hi", "turns"))).alias("x"))
    # A turn that two neighbouring pieces share counts once.
    twice = F.size(F.filter(F.sequence(F.lit(1), F.size("x")), lambda i: F.get("x", i)["lo"] == F.get("x", i - 1)["hi"]))
    turns = F.aggregate("x", F.lit(0).cast("long"), lambda n, p: n + p["turns"]) - twice
    span = F.array_max(F.transform("x", lambda p: p["hi"])) - F.array_min(F.transform("x", lambda p: p["lo"])) + 1
    return parts.select("conv_id", F.array_join(F.transform("x", lambda p: p["word"]), "").alias("word"), F.coalesce(span - turns, F.lit(0)).cast("long").alias("gaps"))


class Graph:
    """The open path of the word graph: for each rest of a word, from the end on, its least cost and its shape."""

    def __init__(self):
        #: Of each shape the costs of the four states above the least one, and the best edit in each.
        self.costs, self.edits, self.known, self.steps = [], [], {}, {}
        end = self._settled([(0, ""), (NEVER, "Z"), (NEVER, "Z"), (0, "")])
        self.word, self.least, self.shape = "", [end[0]], [end[1]]

    def _settled(self, best: list) -> tuple[int, int]:
        """(least cost, shape) of a node with these (cost, edit) in its states, insertions aside."""
        more = lambda x, to: min(x, (to[0] + 2, "I"))
        user, assistant = more(best[USER], best[ASSISTANT]), more(best[ASSISTANT], best[USER])
        best = [more(best[START], user), more(best[SYSTEM], user), user, assistant]
        least = min(c for c, _ in best)
        key = tuple((c - least, e) for c, e in best)
        if key not in self.known:
            self.known[key] = len(self.costs)
            self.costs.append([c for c, _ in key])
            self.edits.append([e for _, e in key])
        return least, self.known[key]

    def _step(self, shape: int, letter: str) -> tuple[int, int]:
        role, fault = divmod(LETTERS.index(letter), 4)
        after, late, best = self.costs[shape], int(fault == TRUNCATED), []
        for state in range(4):
            found = [(after[state] + 3, "D")]
            if fault not in (BLANK, DUPLICATE):
                found.append((after[NEXT[state]] + 2 + late, "R"))
                if KEPT[state][role] is not None:
                    found.append((after[KEPT[state][role]] + late, "K"))
            best.append(min(found))
        return self._settled(best)

    def repair(self, rest: str) -> tuple[int, str]:
        """(cost, audit) of the word that is ``rest`` read backwards; words come in the order of their reversals."""
        same, most = 0, min(len(rest), len(self.word))
        if rest[:most] == self.word[:most]:
            same = most
        else:
            while rest[same] == self.word[same]:
                same += 1
        del self.least[same + 1:], self.shape[same + 1:]
        self.word = rest
        steps, least, shape = self.steps, self.least[-1], self.shape[-1]
        for letter in rest[same:]:
            step = steps.get((shape, letter))
            if step is None:
                step = steps[shape, letter] = self._step(shape, letter)
            least, shape = least + step[0], step[1]
            self.least.append(least)
            self.shape.append(shape)
        audit, state, at = [], START, len(rest)
        while edit := self.edits[self.shape[at]][state]:
            audit.append(edit)
            if edit == "K":
                state = KEPT[state][LETTERS.index(rest[at - 1]) // 4]
            elif edit != "D":
                state = NEXT[state]
            at -= edit != "I"
        return self.least[-1] + self.costs[self.shape[-1]][START], "".join(audit)


def figures(word: str) -> list[int]:
    """Blank, duplicate and truncated rows, and neighbours whose roles may not follow each other."""
    fault, role = word.translate(TO_FAULT), word.translate(TO_ROLE)
    legal = sum(role.count(x) for x in ("su", "ua", "au"))
    return [fault.count(str(BLANK)), fault.count(str(DUPLICATE)), fault.count(str(TRUNCATED)), max(len(word) - 1, 0) - legal]


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(found: DataFrame) -> DataFrame:
    """(conv_id, the figures, audit) of every word."""
    kind = found.schema["conv_id"].dataType.simpleString()

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, last, result = Graph(), None, None
        for batch in batches:
            for part in K.slices(batch, "rest"):
                out = []
                for rest in part.column(1).to_pylist():
                    if rest != last:
                        last, result = rest, (*figures(rest[::-1]), *graph.repair(rest))
                    out.append(result)
                columns = [pa.array(x, pa.string() if i == 5 else pa.int64()) for i, x in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *columns], ["conv_id", *FIGURES, "audit"])

    # Equal words may lie in several ranges, so a word that a third of all conversations share is no hot key.
    rest = found.select("conv_id", F.reverse("word").alias("rest"), "gaps")
    ordered = rest.repartitionByRange("rest", F.xxhash64("conv_id")).sortWithinPartitions("rest")
    return ordered.mapInArrow(repair, f"conv_id {kind}, {', '.join(f'{x} long' for x in FIGURES)}, audit string")


def _in_order(stated: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of every conversation in order, with its figures and audit in a row before them."""
    rows = stated.where("copies > 0").select(*PLACE, F.lit(1).alias("kind"), "copies", "text", *[F.lit(None).cast("long").alias(x) for x in FIGURES], F.lit(None).cast("string").alias("audit"))
    empty = {"has_turn": F.lit(False), "turn": F.lit(None), "role": F.lit(""), "digest": F.lit(None), "kind": F.lit(0), "copies": F.lit(0), "text": F.lit("")}
    heads = found.select("conv_id", *[c.cast(rows.schema[n].dataType).alias(n) for n, c in empty.items()], *FIGURES, "audit")
    order = ["conv_id", "kind", "has_turn", "turn", "role", "digest"]
    return rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "turn", "role", "copies", "text", *FIGURES, "audit")


class Editor:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple]:
        """The rows inserted here: (edit, role)."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield "I", NAME[self.state]

    def row(self, role: str) -> tuple:
        """What becomes of the next row: (edit, role); a deleted one has no role."""
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state][(ROLES.find(role[:1]) if role else -1) % 4]
        elif edit == "R":
            self.state = NEXT[self.state]
            role = NAME[self.state]
        return edit, role if edit != "D" else None


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(kind, payload): 0 with a conversation's id and figures, then 1 with (turn, edit, role, text) of each of its edits; None after each part of a batch."""
    editor = None
    for batch in batches:
        for part in K.slices(batch, "text"):
            columns = [part.column(i).to_pylist() for i in range(part.num_columns)]
            for conv_id, kind, turn, role, copies, text, *rest in zip(*columns):
                if not kind:
                    if editor is not None:
                        yield from ((1, (None, e, r, "")) for e, r in editor.inserted())
                    editor = Editor(rest[-1])
                    yield 0, (conv_id, *rest)
                    continue
                for _ in range(copies):
                    yield from ((1, (None, e, r, "")) for e, r in editor.inserted())
                    yield 1, (turn, *editor.row(role), text)
            yield None, None
    if editor is not None:
        yield from ((1, (None, e, r, "")) for e, r in editor.inserted())


def repair(rows: DataFrame) -> DataFrame:
    """The edits of every conversation in order: (conv_id, place, turn, edit, role, text).

    ``rows`` hold conv_id, turn, role, text and, if given, ``copies``.  The
    repaired conversation is what isn't deleted (``edit`` D).
    """
    stated = _stated(rows if "copies" in rows.columns else rows.withColumn("copies", F.lit(1)))
    kinds = {n: stated.schema[n].dataType.simpleString() for n in ("conv_id", "turn")}
    schema = f"conv_id {kinds['conv_id']}, place long, turn {kinds['turn']}, edit string, role string, text string"
    found, _ = write_table(audits(words(stated)), "audits")

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, out = None, 0, []
        for kind, x in _edited(batches):
            if kind == 0:
                conv, place = x[0], 0
            elif kind == 1:
                out.append((conv, place, *x))
                place += 1
            elif out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    ordered = _in_order(stated, found)
    arrow = pa.schema([("conv_id", _arrow(kinds["conv_id"])), ("place", pa.int64()), ("turn", _arrow(kinds["turn"])), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    return ordered.mapInArrow(edits, schema)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def repair_figures(rows: DataFrame) -> DataFrame:
    """(conv_id, the figures, audit, repaired_sha256) of every conversation; takes what ``repair`` takes."""
    stated = _stated(rows if "copies" in rows.columns else rows.withColumn("copies", F.lit(1)))
    kind = stated.schema["conv_id"].dataType.simpleString()
    arrow = pa.schema([("conv_id", _arrow(kind)), *[(x, pa.int64()) for x in FIGURES], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    found, _ = write_table(audits(words(stated)), "audits")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, total, lines, out = None, hashlib.sha256(), 0, []
        for what, x in _edited(batches):
            if what == 0:
                if head is not None:
                    out.append((*head, total.hexdigest()))
                head, total, lines = x, hashlib.sha256(), 0
            elif what == 1:
                if x[1] != "D":
                    total.update(f"{chr(10) if lines else ''}{x[2]}:{x[3]}".encode())
                    lines += 1
            elif out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if head is not None:
            out.append((*head, total.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    schema = f"conv_id {kind}, {', '.join(f'{x} long' for x in FIGURES)}, audit string, repaired_sha256 string"
    return _in_order(stated, found).mapInArrow(digest, schema)


def _sql() -> str:
    """The query over damaged ``conversations``: one recursion step a row, from the end, with whole audits and texts in four states."""
    cand = lambda cost, edit, of, line="": f"{{'c': {cost} + {of}.c, 'a': '{edit}' || {of}.a, 'r': {f'list_prepend({line}, {of}.r)' if line else f'{of}.r'}}}"
    least = lambda *x: f"list_sort([{', '.join(x)}])[1]"
    never = "{'c': 1000000, 'a': 'Z', 'r': []::VARCHAR[]}"

    def row(state: str, to: str, name: str, keeps: dict[str, str]) -> str:
        free = " ".join(f"WHEN i = '{r}' THEN {cand('late', 'K', v, 'line')}" for r, v in keeps.items())
        return least(cand(3, "D", state), f"CASE WHEN gone THEN {never} ELSE {cand('2 + late', 'R', to, repr(name + ':') + ' || text')} END", f"CASE WHEN gone THEN {never} {free} ELSE {never} END")

    add = lambda of, name: cand(2, "I", of, f"'{name}:'")
    b = {"bt": row("vt", "vu", "user", {"s": "vs", "u": "vu"}), "bs": row("vs", "vu", "user", {"u": "vu"}), "bu": row("vu", "va", "assistant", {"a": "va"}), "ba": row("va", "vu", "user", {"u": "vu"})}
    nothing = "{'c': 0, 'a': '', 'r': []::VARCHAR[]}"
    one = "{'c': 2, 'a': 'I', 'r': ['assistant:']}"
    two = "{'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']}"
    return rf"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, role, text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS ky FROM conversations),
marked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC_SQL} % 20 AS d FROM (SELECT *, hex(encode(ky)) AS hx FROM keyed) x),
dealt AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN d = 0 THEN 0 WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS n, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, substr(role, 1, 1) AS i FROM dealt),
seen AS (SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS twin, i || lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS pair FROM placed),
faults AS (SELECT *, blank OR twin AS gone, CASE WHEN blank OR twin OR right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS late, role || ':' || text AS line FROM seen),
figs AS (SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum(twin::INT) AS duplicate, sum(late) AS truncated,
  sum(CASE WHEN pair IS NULL OR pair IN ('us', 'au', 'ua') THEN 0 ELSE 1 END) AS illegal FROM faults GROUP BY conv_id),
rec AS (SELECT conv_id, rows AS n, {nothing} AS vt, {two} AS vs, {one} AS vu, {nothing} AS va FROM figs
  UNION ALL SELECT conv_id, n - 1, {least('bt', add('u', 'user'))}, {least('bs', add('u', 'user'))}, u, {least('ba', add('bu', 'user'))}
  FROM (SELECT *, {least('bu', add('ba', 'assistant'))} AS u FROM (
    SELECT rec.conv_id, rec.n, {', '.join(f'{v} AS {k}' for k, v in b.items())}
    FROM rec JOIN faults f ON f.conv_id IS NOT DISTINCT FROM rec.conv_id AND f.n = rec.n WHERE rec.n > 0) x) y)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(vt.c, 0)::BIGINT AS cost, coalesce(vt.a, '') AS audit, sha256(coalesce(array_to_string(vt.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN figs g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN (SELECT * FROM rec WHERE n = 0) r ON r.conv_id IS NOT DISTINCT FROM c.conv_id"""


SQL = _sql()
