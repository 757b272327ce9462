"""Conversations of any layout as one training text with a loss mask.

A layout is recognised by its fingerprint, the hash of the nested field paths
it uses; a declarative mapping chosen by the fingerprint gives the turns. A
table's fingerprint comes from its schema; JSON records are recognised one by
one. Fields no layout knows are ignored.

The text marks turns as ``<turn ROLE>``, line feed, text, ``</turn>``, line
feed. Inside roles and texts the three characters that could be mistaken for
marks are replaced, one to one: backslash by backslash b, ``<`` by backslash
l, ``>`` by backslash g. So no text can close its turn, and reading back
gives every character again. The loss mask lists, per assistant turn, the
number of the turn and the place of the text in it, in code points.

Turns are ordered by number, null first, then role and text; repeated rows
stay. Null texts and roles are empty. A null conversation id is a
conversation of its own; a record of unknown layout has no turns and is kept
with ``layout`` null. An empty table gives an empty result. Everything is
DataFrame functions. A conversation is one text, so its turns meet in one
task; conversations of any number spread over all tasks.
"""

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"
#: every field that some layout uses, as one record
RECORD = (
    "conv_id long, messages array<struct<role:string,content:string>>, "
    "conversations array<struct<`from`:string,value:string>>, system string, instruction string, input string, "
    "output string, prompt string, completion string, response string, question string, answer string"
)
# Names of the speakers in public layouts.
SPEAKERS = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _turn(role: str | Column, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _speaker(role: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in SPEAKERS.items() for x in pair])
    return F.coalesce(F.element_at(named, F.lower(role)), role, F.lit(""))


def _listed(items: str, role: str, text: str) -> Callable[[Column], Column]:
    return lambda r: F.transform(r[items], lambda m: _turn(_speaker(m[role]), m[text]))


def _fields(**roles: tuple[str, ...]) -> Callable[[Column], Column]:
    """One turn per role, of the named fields one below the other."""
    return lambda r: F.array(*[_turn(role, F.concat_ws("\n", *[r[n] for n in names])) for role, names in roles.items()])


@dataclass(frozen=True)
class Layout:
    name: str
    paths: tuple[str, ...]
    turns: Callable[[Column], Column]

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


LAYOUTS = [
    Layout("messages", ("messages[].role", "messages[].content"), _listed("messages", "role", "content")),
    Layout("exchange", ("conversations[].from", "conversations[].value"), _listed("conversations", "from", "value")),
    Layout("instruction", ("instruction", "output"), _fields(user=("instruction",), assistant=("output",))),
    Layout(
        "instruction_input", ("instruction", "input", "output"), _fields(user=("instruction", "input"), assistant=("output",))
    ),
    Layout(
        "instruction_system",
        ("system", "instruction", "output"),
        _fields(system=("system",), user=("instruction",), assistant=("output",)),
    ),
    Layout("prompt_completion", ("prompt", "completion"), _fields(user=("prompt",), assistant=("completion",))),
    Layout("prompt_response", ("prompt", "response"), _fields(user=("prompt",), assistant=("response",))),
    Layout("question_answer", ("question", "answer"), _fields(user=("question",), assistant=("answer",))),
]
TURN_ROWS = Layout("turn_rows", ("conv_id", "turn", "role", "text"), lambda r: F.array(_turn(r["role"], r["text"])))
#: identifies a record but not its layout
KEYS = ("conv_id",)


def fingerprint(paths: Iterable[str]) -> str:
    """The hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Paths of all leaves; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, prefix + "[]")
    return [prefix]


def _known(layouts: list[Layout]) -> set[str]:
    return {path for layout in layouts for path in layout.paths}


def layout_of(schema: T.StructType) -> Layout | None:
    """The layout of a table by the fingerprint of its schema, extra fields aside."""
    found = set(field_paths(schema))
    if set(TURN_ROWS.paths) <= found:
        return TURN_ROWS
    by_print = {layout.fingerprint: layout for layout in LAYOUTS}
    return by_print.get(fingerprint(found & _known(LAYOUTS)))


def _present(record: Column, path: str) -> Column:
    if "[]." in path:
        items, field = path.split("[].")
        return F.exists(record[items], lambda m: m[field].isNotNull())
    return record[path].isNotNull()


def turns_of_table(df: DataFrame) -> DataFrame:
    """Turn rows (conv_id, turn, role, text) of a table whose schema is a known layout."""
    layout = layout_of(df.schema)
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(field_paths(df.schema))}")
    if layout is TURN_ROWS:
        return df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    record = F.struct(*[F.col(name) for name in dict.fromkeys(p.split("[")[0] for p in layout.paths)])
    return _exploded(df.select("conv_id", layout.turns(record).alias("turns")))


def turns_of_json(df: DataFrame, column: str) -> DataFrame:
    """Turn rows of JSON records of mixed layouts, with the name of the ``layout`` found."""
    records = df.select(F.from_json(column, RECORD).alias("r"))
    known = sorted(_known(LAYOUTS))
    present = F.filter(
        F.array(*[F.when(_present(F.col("r"), path), F.lit(path)) for path in known]), lambda path: path.isNotNull()
    )
    marked = records.withColumn("print", F.sha2(F.array_join(present, "\n").cast("binary"), 256))
    turns, name = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for layout in LAYOUTS:
        hit = F.col("print") == layout.fingerprint
        turns = F.when(hit, layout.turns(F.col("r"))).otherwise(turns)
        name = F.when(hit, F.lit(layout.name)).otherwise(name)
    return _exploded(marked.select(F.col("r.conv_id").alias("conv_id"), turns.alias("turns"), name.alias("layout")))


def _exploded(records: DataFrame) -> DataFrame:
    others = [c for c in records.columns if c != "turns"]
    return records.select(*others, F.posexplode_outer("turns").alias("turn", "t")).select(*others, "turn", "t.role", "t.text")


def escaped(text: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for raw, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def formatted(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, the ``formatted`` text, and ``loss_spans`` (turn, start, length)."""
    block = F.concat(F.lit("<turn "), escaped(F.col("role")), F.lit(">\n"), escaped(F.col("text")), F.lit("</turn>\n"))
    rows = turns.select(
        "conv_id",
        F.when(
            F.col("role").isNotNull(),
            F.struct(
                F.col("turn").cast("long").alias("turn"),
                "role",
                "text",
                block.alias("block"),
                (F.length(F.lit("<turn >\n")) + F.length(escaped(F.col("role")))).alias("start"),
                F.length(escaped(F.col("text"))).alias("length"),
            ),
        ).alias("t"),
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    spans = F.filter(
        F.transform(
            "turns",
            lambda t, i: F.when(t["role"] == "assistant", F.struct(i.alias("turn"), t["start"].alias("start"), t["length"].alias("length"))),
        ),
        lambda span: span.isNotNull(),
    )
    text = F.array_join(F.transform("turns", lambda t: t["block"]), "")
    return whole.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_texts``, both taken from the text and the mask alone."""
    blocks = F.split(F.col("formatted"), "</turn>\n")
    chats = chats.withColumn("blocks", F.slice(blocks, F.lit(1), F.size(blocks) - 1))
    head = F.lit(">\n")

    def parsed(block: Column) -> Column:
        at = F.instr(block, head)
        role = F.substring(block, F.lit(7), at - 7)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substring(block, at + 2, F.length(block))).alias("text"))

    def under(span: Column) -> Column:
        return unescaped(F.substring(F.get("blocks", span["turn"]), span["start"] + 1, span["length"]))

    return chats.withColumns(
        {"turns": F.transform("blocks", parsed), "loss_texts": F.transform("loss_spans", under)}
    ).drop("blocks")


def report(turns: DataFrame) -> DataFrame:
    """Per conversation what reading its text back gives: turns and loss text as digests, and lengths."""
    chats = read_back(formatted(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
