"""Chat records of many layouts, brought to one template.

The field paths of a record, nested ones included, are hashed. The hash selects a
mapping, which says where the turns are. No field is looked for by trial.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
#: Records longer than this are fingerprinted without their long values, and read with the
#: schema of their layout.
LONG_RECORD, LONG_VALUE = 1_000_000, 1_000
#: Names that stand for a canonical role.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
         "model": "assistant"}
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``paths`` is the layout's field paths as ``field_paths`` writes them. Either
    ``fields`` lists (role, field) in order, or ``items`` names the list of turns, whose
    entries hold the role in ``role`` and the text in ``text``. ``roles`` says which names stand
    for others in this layout.
    """

    name: str
    paths: str
    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = tuple(ROLES.items())

    def schema(self) -> str:
        """Of the layout's JSON, with every scalar read as a string."""
        if self.fields:
            return "struct<" + ", ".join(f"{field}: string" for _, field in self.fields) + ">"
        inner = f"array<struct<{self.role}: string, {self.text}: string>>"
        for name in reversed(self.items.split(".")):
            inner = f"struct<{name}: {inner}>"
        return inner

    def turns_of_long(self, record: Column) -> Column:
        """The turns of a JSON string that is too long for a variant."""
        read = F.from_json(record, self.schema(), {"maxStringLen": str((1 << 31) - 1)})
        if self.fields:
            return F.array(*[F.struct(F.lit(role).alias("role"), read[field].alias("text")) for role, field in self.fields])
        for name in self.items.split("."):
            read = read[name]
        return F.transform(read, lambda t: F.struct(t[self.role].alias("role"), t[self.text].alias("text")))

    def turns(self, record: Column) -> Column:
        if self.fields:
            return F.array(*[
                F.struct(F.lit(role).alias("role"),
                         F.variant_get(record, f"$.{field}", "string").alias("text"))
                for role, field in self.fields])
        entries = F.variant_get(
            record, f"$.{self.items}", f"array<struct<{self.role}: string, {self.text}: string>>")
        return F.transform(entries, lambda t: F.struct(
            t[self.role].alias("role"), t[self.text].alias("text")))


MAPPINGS = (
    Mapping("prompt", "OBJECT<prompt: *, response: *>",
            fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("completion", "OBJECT<completion: *, prompt: *>",
            fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", "OBJECT<input: *, instruction: *, output: *>",
            fields=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("plain instruction", "OBJECT<instruction: *, output: *>",
            fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content: *, role: *>>>",
            items="messages", role="role", text="content"),
    Mapping("conversations", "OBJECT<conversations: ARRAY<OBJECT<from: *, value: *>>>",
            items="conversations", role="from", text="value"),
    Mapping("dialog", "OBJECT<dialog: OBJECT<turns: ARRAY<OBJECT<speaker: *, text: *>>>>",
            items="dialog.turns", role="speaker", text="text"),
    Mapping("turns", "OBJECT<turns: ARRAY<OBJECT<role: *, text: *>>>",
            items="turns", role="role", text="text", roles=()),
)


def field_paths(record: Column) -> Column:
    """The sorted field paths of a variant; ``*`` stands for a value of any scalar type."""
    return F.regexp_replace(F.schema_of_variant(record), r"(?<=[ <])[A-Z_]+(\([0-9,]+\))?(?=[,>]|$)", "*")


def outline(record: Column) -> Column:
    """The JSON string with a letter in the place of each long string in it. Escaped quotes are
    taken out first, so that every second part between quotes is the inside of a string."""
    bare = F.replace(F.replace(record, F.lit("\\\\"), F.lit("__")), F.lit('\\"'), F.lit("__"))
    return F.array_join(F.transform(F.split(bare, '"'), lambda part, i: F.when(
        (i % 2 == 1) & (F.length(part) > LONG_VALUE), F.lit("x")).otherwise(part)), '"')


def escape(text: Column) -> Column:
    """No ``<`` is left, so markers cannot occur in a text. ``unescape`` undoes it."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later lambdas and filters read and do not evaluate again."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def canonical_turns(
    records: DataFrame, id: str = "conv_id", record: str = "record",
    mappings: tuple[Mapping, ...] = MAPPINGS,
) -> DataFrame:
    """``<id>, fingerprint, layout, turns`` for records given as JSON strings.

    ``turns`` are (role, text), a null in either being an empty string, and roles under
    their layout's canonical names. A record that is null, is no JSON or has unknown field paths
    keeps its row, with null ``layout`` and null ``turns``. Equal rows stay; other columns
    are left out. Texts may be of any length; a record of so many short turns that its
    outline cannot be parsed is an error, not a null.
    """
    is_long = F.length(record) > LONG_RECORD
    short = F.try_parse_json(F.when(is_long, outline(F.col(record))).otherwise(F.col(record)))
    too_long = is_long & short.isNull() & F.json_object_keys(outline(F.col(record))).isNotNull()
    parsed = records.select(
        F.col(id).alias("id"), F.when(is_long, F.col(record)).alias("long"),
        F.when(too_long, F.raise_error(F.lit("a record has too many turns")).cast("variant")).otherwise(short).alias("v"))
    marked = parsed.withColumn("fingerprint", F.xxhash64(field_paths(F.col("v"))))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        is_it = F.col("v").isNotNull() & (F.col("fingerprint") == F.xxhash64(F.lit(m.paths)))
        layout = F.when(is_it, F.lit(m.name)).otherwise(layout)
        turns = F.when(is_it & F.col("long").isNotNull(), _canonical(m.turns_of_long(F.col("long")), m.roles)).when(
            is_it, _canonical(m.turns(F.col("v")), m.roles)).otherwise(turns)

    return marked.select(
        F.col("id").alias(id), F.when(F.col("v").isNotNull(), F.col("fingerprint")).alias("fingerprint"),
        layout.alias("layout"), turns.alias("turns"))


def _canonical(turns: Column, roles: tuple[tuple[str, str], ...]) -> Column:
    names = F.create_map(*[F.lit(x) for pair in roles for x in pair]).cast("map<string, string>")

    def turn(t: Column) -> Column:
        role = F.coalesce(t["role"], F.lit(""))
        return F.struct(F.coalesce(F.try_element_at(names, role), role).alias("role"),
                        F.coalesce(t["text"], F.lit("")).alias("text"))

    return F.transform(turns, turn)


def render(turns: DataFrame, id: str = "conv_id") -> DataFrame:
    """Add ``formatted`` and ``loss_spans`` (start, length in characters of the formatted
    text that count for the loss: the texts of assistant turns). Null turns give nulls."""
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("learned")))
    split = _once(turns, "_parts", parts)
    step = F.aggregate(
        "_parts",
        F.struct(F.lit(0).alias("at"),
                 F.array().cast("array<struct<start: int, length: int>>").alias("spans")),
        lambda state, p: F.struct(
            (state["at"] + F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).alias("at"),
            F.when(p["learned"], F.array_append(state["spans"], F.struct(
                (state["at"] + F.length(p["head"])).alias("start"),
                F.length(p["body"]).alias("length")))).otherwise(state["spans"]).alias("spans")),
        lambda state: state["spans"])
    formatted = F.array_join(
        F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return split.withColumns({"formatted": formatted, "loss_spans": step}).drop("_parts")


def format_chat(
    records: DataFrame, id: str = "conv_id", record: str = "record",
    mappings: tuple[Mapping, ...] = MAPPINGS,
) -> DataFrame:
    """``<id>, fingerprint, layout, formatted, loss_spans``; see ``canonical_turns``."""
    return render(canonical_turns(records, id, record, mappings), id).drop("turns")


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted text."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turn(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        return F.struct(
            _unescape_role(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(block, F.length(head) + 2)).alias("text"))

    return F.transform(blocks, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, one after the other."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["length"]))), "")


def records_of_turns(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``<id>, record``: rows of single turns gathered into JSON records.

    What can be said as a prompt with its response, or as an instruction, becomes such a
    record; other conversations become a list of messages under one of three layouts. Roles
    that are not usual are kept as they are, whatever other layouts mean by them.
    Turns are ordered by ``turn``, then role, then text, nulls first. Null roles and texts are
    empty. A conversation is one row here, as it must be in any formatted output; a row
    without an id belongs to no other and is a conversation of its own.
    """
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                    F.coalesce(text, F.lit("")).alias("text"))
    alone = F.when(F.col(id).isNull(), F.monotonically_increasing_id())
    gathered = turns.select(F.col(id).alias("id"), alone.alias("alone"), said.alias("said")).groupBy("id", "alone").agg(
        F.sort_array(F.collect_list("said")).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    text_at = lambda i: F.get("t", F.lit(i))["text"]
    are = lambda *names: roles == F.array(*map(F.lit, names))
    usual = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    other = F.pmod(F.xxhash64("id"), F.lit(3))

    def listed(role_key: str, text_key: str, rename: dict[str, str] | None = None) -> Column:
        def entry(t: Column) -> Column:
            name = t["role"]
            for old, new in (rename or {}).items():
                name = F.when(t["role"] == old, new).otherwise(name)
            return F.struct(name.alias(role_key), t["text"].alias(text_key))
        return F.transform("t", entry)

    record = (
        F.when(are("user", "assistant"), F.to_json(F.struct(
            text_at(0).alias("prompt"), text_at(1).alias("response"))))
        .when(are("system", "user", "assistant"), F.to_json(F.struct(
            text_at(0).alias("instruction"), text_at(1).alias("input"), text_at(2).alias("output"))))
        .when(usual & (other == 0), F.to_json(F.struct(
            listed("from", "value", {"user": "human", "assistant": "gpt"}).alias("conversations"))))
        .when(usual & (other == 1), F.to_json(F.struct(
            F.struct(listed("speaker", "text").alias("turns")).alias("dialog"))))
        .when(usual, F.to_json(F.struct(listed("role", "content").alias("messages"))))
        .otherwise(F.to_json(F.struct(listed("role", "text").alias("turns")))))
    return gathered.select(F.col("id").alias(id), record.alias("record"))
