"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a declarative template.

A template names the marks around each role's text, which texts are trained on, and the machine: from which state which
role leads to which state. Order is checked by composing transition functions: a turn is a function of states, those of
a chunk of turns are composed where they are, chunks are composed level by level. So neither a conversation of very many
turns nor one turn that repeats very often is ever held by one task. Formatting is a projection of each row: texts do not
move. Marks inside texts are broken by the template's escape character, which reading takes out again.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.session import ship

#: Breaks marks inside texts: put after a mark's first character, and after each of itself.
ESCAPE = "\\"
#: Turn numbers of a chunk of the machine, and chunks of a chunk on the next level.
CHUNK, FANOUT = 1024, 64


@dataclass(frozen=True)
class Marks:
    """What stands before and after a role's text, and whether the text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """roles: marks of each role. other: marks of any other role, whose name stands between other.open and named.

    moves: for each state, the state that a role leads to; what is not listed is an error. A role that is not in roles
    moves as `*`. A conversation is valid if its turns lead from start to one of the states in final.
    """

    roles: dict[str, Marks]
    other: Marks
    named: str
    moves: dict[str, dict[str, str]]
    start: str
    final: tuple[str, ...]
    marks: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        every = [*self.roles.values(), self.other]
        spaced = [m for x in every for m in (x.open, x.close)] + [self.named]
        marks = [m.strip() for m in spaced]
        object.__setattr__(self, "marks", tuple(marks))
        if any(len(m) < 2 or ESCAPE in m for m in marks) or len(set(marks)) < len(marks):
            raise ValueError("marks must differ, have two characters at least and not hold the escape character")
        for a in marks:
            if any(a != b and a in b for b in marks):
                raise ValueError(f"{a} is part of another mark")
            for at in range(1, len(a)):  # a text that ends in the first part must not make a mark with what follows it
                if any(m.startswith(a[at:]) or a[at:].startswith(m) for m in spaced):
                    raise ValueError(f"the end of {a} begins another mark")

    @property
    def states(self) -> list[str]:
        """All states; the error, that nothing leaves, is the one after them."""
        return sorted({self.start, *self.moves, *(x for m in self.moves.values() for x in m.values())})

    def table(self) -> list[list[int]]:
        """For each role's code (its place in roles, then one for all others) the next state of each state."""
        states = self.states
        codes = [*self.roles, "*"]
        return [[*(states.index(to) if (to := self.moves.get(s, {}).get(c)) else len(states) for s in states), len(states)] for c in codes]


#: User turns between instruction marks, assistant turns between sentence marks, an optional system turn first.
INSTRUCT = Template(
    roles={"system": Marks("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": Marks("[INST] ", " [/INST]"), "assistant": Marks("<s>", "</s>", loss=True)},
    other=Marks("[ROLE]", "[/TURN]"), named="[/ROLE]",
    moves={"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user"}},
    start="start", final=("assistant",),
)


def _code(role: Column, template: Template) -> Column:
    """The place of a role in the template; all others and null share the next one."""
    out = F.lit(len(template.roles))
    for i, name in enumerate(template.roles):
        out = F.when(role == name, i).otherwise(out)
    return out


def escaped(text: Column, template: Template) -> Column:
    """text without any mark: the escape character follows each of itself and the first character of each mark."""
    own = re.escape(ESCAPE)
    doubled = F.regexp_replace(text, own, own * 2)
    return F.regexp_replace(doubled, f"(?s)(?={'|'.join(map(re.escape, template.marks))})(.)", f"$1{own}")


def unescaped(text: str) -> str:
    return re.sub(re.escape(ESCAPE) + "(.)", lambda m: m[1] if m[1] == ESCAPE else m[1], text, flags=re.DOTALL) if ESCAPE in text else text


def format_turns(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, turn, code, role, segments: array of text, loss) of turns (conv_id, turn, role, text and any others).

    A row's segments in order of (turn, code, role, segments) make its conversation's formatted text; turns that share
    a number come in this order, null numbers first. Null texts and roles count as empty. Roles that the template does
    not list keep their name in the marks. Repeated rows are turns of their own. An empty table gives an empty one.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    code = _code(role, template)
    seg = lambda x, loss=False: F.struct(x.alias("text"), F.lit(loss).alias("loss"))
    out = F.array(seg(F.concat(F.lit(template.other.open), escaped(role, template), F.lit(template.named))), seg(escaped(text, template), template.other.loss), seg(F.lit(template.other.close)))
    for name, m in template.roles.items():
        out = F.when(role == name, F.array(seg(F.lit(m.open)), seg(escaped(text, template), m.loss), seg(F.lit(m.close)))).otherwise(out)
    return turns.select("conv_id", "turn", code.alias("code"), role.alias("role"), out.alias("segments"))


def check_order(turns: DataFrame, template: Template = INSTRUCT, chunk: int = CHUNK, fanout: int = FANOUT) -> DataFrame:
    """(conv_id, n_turns, valid, bad_turn) of each conversation of turns (conv_id, turn, role).

    The machine reads turns by number, then by the role's place in the template. bad_turn: number of the first turn that
    no move allows; null if there is none (then an invalid conversation ends too early) or if it has no number. Null
    ids make one conversation, null numbers come first. An empty table gives an empty one.
    """
    table, error = template.table(), len(template.states)
    names = len(template.states) + 1
    lap = math.lcm(*range(1, names + 1))  # after so many more turns of one role, any state is where it was
    kind = "array<struct<state: int, bad: long>>"
    identity = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(None).cast("long").alias("bad")) for s in range(names)]).cast(kind)
    delta = F.array(*[F.array(*map(F.lit, row)) for row in table])

    def then(first: Column, second: Column) -> Column:
        return F.transform(first, lambda p: F.when(p["state"] == error, p).otherwise(F.element_at(second, p["state"] + 1)))

    rows = turns.groupBy("conv_id", "turn", _code(F.coalesce("role", F.lit("")), template).alias("code")).agg(F.count("*").alias("n"))
    step = F.transform(F.element_at(delta, F.col("code") + 1), lambda s: F.struct(s.alias("state"), F.when(s == error, F.col("turn").cast("long")).alias("bad"))).cast(kind)
    times = F.when(F.col("n") <= names, F.col("n")).otherwise(names + (F.col("n") - names) % lap)
    rows = rows.withColumn("f", F.aggregate(F.sequence(F.lit(1).cast("long"), times), identity, lambda acc, _: then(acc, step)))
    rows = rows.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), F.col("code").cast("long").alias("code")).alias("at"), F.floor(F.col("turn") / chunk).alias("chunk"), "n", "f")
    depth = rows.agg(F.max(F.abs("chunk"))).first()[0] or 0
    while True:
        parts = rows.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "f"))).alias("parts"), F.sum("n").alias("n"))
        rows = parts.select("conv_id", "chunk", F.aggregate("parts", identity, lambda acc, x: then(acc, x["f"])).alias("f"), "n")
        if chunk == 0:
            break
        # nulls sort first, before all chunks
        rows = rows.select("conv_id", F.struct(F.col("chunk"), F.lit(0).cast("long").alias("code")).alias("at"), (F.floor(F.col("chunk") / fanout) if depth >= fanout else F.lit(0)).cast("long").alias("chunk"), "n", "f")
        chunk, depth = (chunk, -(-depth // fanout)) if depth >= fanout else (0, 0)
    end = F.element_at("f", template.states.index(template.start) + 1)
    good = [template.states.index(x) for x in template.final]
    return rows.select("conv_id", F.col("n").alias("n_turns"), end["state"].isin(*good).alias("valid"), end["bad"].alias("bad_turn"))


class Reader:
    """Reads a conversation's formatted segments back, one by one, and keeps digests only.

    A segment is one or more whole marks and texts. Raises ValueError where the text does not follow the template.
    """

    def __init__(self, template: Template = INSTRUCT):
        self.template = template
        self.split = re.compile("|".join(map(re.escape, sorted(template.marks, key=len, reverse=True))))
        self.by_open = {m.open.strip(): (name, m) for name, m in template.roles.items()} | {template.other.open.strip(): (None, template.other)}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.inside = None  # marks of the turn that is open, its role (None until its name is read)
        self.parts: list[tuple[str, bool]] = []

    def feed(self, text: str, loss: bool) -> None:
        self.formatted_chars += len(text)
        at = 0
        for m in self.split.finditer(text):
            self._text(text[at : m.start()], loss)
            self._mark(m[0])
            at = m.end()
        self._text(text[at:], loss)

    def _text(self, text: str, loss: bool) -> None:
        if text:
            self.parts.append((text, loss))

    def _mark(self, mark: str) -> None:
        if self.inside is None:
            if mark not in self.by_open or "".join(t for t, _ in self.parts) != self._after:
                raise ValueError(f"{mark} outside a turn")
            role, marks = self.by_open[mark]
            self.inside, self.parts = [marks, role], []
            self._skip = marks.open[len(marks.open.rstrip()) :]
        elif self.inside[1] is None and mark == self.template.named.strip():
            self.inside[1] = unescaped("".join(t for t, _ in self.parts))
            self.parts = []
        elif mark == self.inside[0].close.strip() and self.inside[1] is not None:
            self._close(*self.inside)
            self._after = self.inside[0].close[len(self.inside[0].close.rstrip()) :]
            self.inside, self.parts = None, []
        else:
            raise ValueError(f"{mark} inside a turn")

    _after, _skip = "", ""

    def _close(self, marks: Marks, role: str) -> None:
        """The blanks of the marks are cut off at both ends; what is left is the turn's text, trained on where flagged."""
        lead = marks.close[: len(marks.close) - len(marks.close.lstrip())]
        text = "".join(t for t, _ in self.parts)
        if not (text.startswith(self._skip) and text.endswith(lead) and len(text) >= len(self._skip) + len(lead)):
            raise ValueError("a mark without its blanks")
        low, high, at = len(self._skip), len(text) - len(lead), 0
        own = text[low:high]
        body = unescaped(own)
        self.n_turns += 1
        self.turns.update(f"{role}\n".encode())
        self.turns.update(body.encode("utf-8", "surrogatepass"))
        self.turns.update(b"\n")
        masked = []
        for part, loss in self.parts:
            if loss:
                masked.append(text[max(at, low) : min(at + len(part), high)])
            at += len(part)
        trained = unescaped("".join(masked))
        self.loss_chars += len(trained)
        self.loss.update(trained.encode("utf-8", "surrogatepass"))

    def end(self) -> tuple:
        if self.inside is not None or "".join(t for t, _ in self.parts) != self._after:
            raise ValueError("a turn without an end")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from format_turns()'s segments.

    A digest over a conversation goes through its turns one after the other, so a conversation is read by one task; it
    is streamed from a sorted partition, of which a batch at a time is in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, reader, began, done = None, Reader(template), False, []

        def pack() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for conv, segments in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if began and conv != who:
                    done.append((who, *reader.end()))
                    reader = Reader(template)
                who, began = conv, True
                for s in segments.as_py():
                    reader.feed(s["text"], s["loss"])
            if len(done) >= 1000:
                yield pack()
                done.clear()
        if began:
            done.append((who, *reader.end()))
            yield pack()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ship(formatted.sparkSession)
    rows = formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "code", "role", "segments").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "code", "role", "segments")
    return rows.select("conv_id", "segments").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A conversation whose texts hold marks.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold marks, formatted, validated, and read back from the segments."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))
    order = check_order(turns).select(F.col("conv_id").alias("_id"), "valid", "bad_turn")
    read = read_back(format_turns(turns))
    return read.join(order, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")


OP12_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
m AS (SELECT unnest(['<<SYS>>', '<</SYS>>', '[INST]', '[/INST]', '<s>', '</s>', '[ROLE]', '[/TURN]', '[/ROLE]']) AS mark),
c AS (SELECT *, CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END AS code, row_number() OVER () AS rid FROM t),
x AS (SELECT rid, sum((length(s) - length(replace(s, mark, ''))) // length(mark)) AS marks
  FROM (SELECT rid, unnest([text, CASE code WHEN 3 THEN role ELSE '' END]) AS s FROM c) CROSS JOIN m GROUP BY rid),
e AS (SELECT c.*, length(text) + length(text) - length(replace(text, '\', '')) + x.marks
    + CASE code WHEN 0 THEN 19 WHEN 1 THEN 15 WHEN 2 THEN 7 ELSE 20 + 2 * length(role) - length(replace(role, '\', '')) END AS chars,
  lag(code) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code, role, text) AS before,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code, role, text) AS place,
  count(*) OVER (PARTITION BY conv_id) AS n FROM c JOIN x USING (rid)),
f AS (SELECT *, NOT CASE WHEN before IS NULL THEN code IN (0, 1) WHEN before = 0 THEN code = 1 WHEN before = 1 THEN code = 2 ELSE before = 2 AND code = 1 END AS bad FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE code = 2), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE code = 2), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars,
  NOT bool_or(bad) AND arg_max(code, place) = 2 AS valid, arg_min(turn, place) FILTER (WHERE bad) AS bad_turn
FROM f GROUP BY conv_id
"""
