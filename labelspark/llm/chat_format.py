"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record is a variant of any layout: a list of messages, a prompt with its response, an instruction with its input and
output, or one turn per row. The hash of its nested field paths, as far as layouts declare them, is its fingerprint; a
declarative mapping for that fingerprint says where the turns are. Canonical turns are then written in a template:

    ### user
    text</turn>

Control strings inside texts are escaped (see ``escape``), so a formatted conversation reads back exactly. Spans of what
the assistant said, in characters of the formatted text, are its loss mask.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

HEAD, END = "### ", "</turn>\n"
BLOCK = 64  # turns that are written together before a conversation's blocks are joined


@dataclass(frozen=True)
class Layout:
    """Where a layout has its turns: ``turns`` is a path to a list whose items have ``role`` and ``text`` paths, or
    ``fields`` names a role and a path for each turn of the record, in order."""

    name: str
    paths: tuple[str, ...]
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    fields: tuple[tuple[str, str], ...] = ()


# Field names of layouts in wide use.
LAYOUTS = (
    Layout("turn", ("role", "text"), fields=(("$.role", "$.text"),)),
    Layout("messages", ("messages[].content", "messages[].role"), "$.messages", "$.role", "$.content"),
    Layout("conversations", ("conversations[].from", "conversations[].value"), "$.conversations", "$.from", "$.value"),
    Layout("dialog", ("dialog[].content", "dialog[].role"), "$.dialog", "$.role", "$.content"),
    Layout("prompt_response", ("prompt", "response"), fields=(("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("prompt_completion", ("completion", "prompt"), fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("question_answer", ("answer", "question"), fields=(("user", "$.question"), ("assistant", "$.answer"))),
    Layout("instruction_output", ("instruction", "output"),
           fields=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("instruction_input_output", ("input", "instruction", "output"),
           fields=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("system_prompt_response", ("prompt", "response", "system"),
           fields=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response"))),
)
# Other names of the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(record: Column, depth: int = 4) -> Column:
    """Paths to the leaves of a variant, lists as ``[]``, items of a list taken together. Types do not count.

    What lies deeper than ``depth`` counts as a leaf; null for what is no object.
    """
    entries = F.map_entries(F.try_variant_get(record, "$", "map<string,variant>"))
    if depth == 1:
        return F.transform(entries, lambda e: e["key"])

    def under(prefix: Column, inner: Column) -> Column:
        return F.when(F.size(inner) > 0, F.transform(inner, lambda p: F.concat(prefix, p))).otherwise(F.array(prefix))

    def one(e: Column) -> Column:
        items = F.try_variant_get(e["value"], "$", "array<variant>")
        in_items = F.array_distinct(F.flatten(F.transform(items, lambda v: F.coalesce(
            F.transform(field_paths(v, depth - 1), lambda p: F.concat(F.lit("."), p)), F.array(F.lit(""))))))
        inside = F.transform(field_paths(e["value"], depth - 1), lambda p: F.concat(F.lit("."), p))
        return (F.when(items.isNotNull(), under(F.concat(e["key"], F.lit("[]")), in_items))
                .when(inside.isNotNull(), under(e["key"], inside)).otherwise(F.array(e["key"])))

    return F.array_distinct(F.flatten(F.transform(entries, one)))


def _depth(layouts: tuple[Layout, ...]) -> int:
    return 1 + max(p.count(".") for layout in layouts for p in layout.paths)


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of those of a record's nested field paths that layouts declare; other fields do not matter.

    Null for what is no object, and where a declared text is itself a list or an object, or an item of a declared list
    is no object: a mapping would lose what is in there.
    """
    declared = sorted({p for layout in layouts for p in layout.paths})
    lists = sorted({p.rsplit(".", 1)[0] for p in declared if "[]." in p})
    odd = lambda p: F.lit(False) if not lists else p.isin(*lists)

    def deeper(p: Column) -> Column:
        return F.exists(F.array(*map(F.lit, declared)), lambda d: p.startswith(F.concat(d, F.lit("."))) | p.startswith(F.concat(d, F.lit("["))))

    def judge(paths: Column) -> Column:
        here = F.array_sort(F.array_intersect(paths, F.array(*map(F.lit, declared))))
        return F.when(~F.exists(paths, lambda p: deeper(p) | odd(p)), F.sha2(F.array_join(here, "\n"), 256))

    return let(field_paths(record, _depth(layouts) + 1), judge)


def layout_key(layout: Layout) -> str:
    """The string whose hash is the fingerprint of the layout's records."""
    return "\n".join(sorted(layout.paths))


def _text(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))


def _role(v: Column, role: str) -> Column:
    raw = _text(v, role) if role.startswith("$") else F.lit(role)
    out = raw
    for other, name in ROLES.items():
        out = F.when(raw == other, name).otherwise(out)
    return out


def turns_of(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Canonical turns (role, text) of a record by its fingerprint's mapping; null where no layout fits.

    A record fits the layout whose declared paths are exactly the declared ones that it has, so fields that no layout
    declares (ids, sources, names of speakers) may stand anywhere.
    """
    known = F.create_map(*(x for layout in layouts for x in (F.sha2(F.lit(layout_key(layout)), 256), F.lit(layout.name))))

    def mapped(name: Column) -> Column:
        out = None
        for layout in layouts:
            if layout.turns:
                value = _items(F.try_variant_get(record, layout.turns, "array<variant>"), layout)
            else:
                value = F.array(*(F.struct(_role(record, r).alias("role"), _text(record, t).alias("text")) for r, t in layout.fields))
            out = F.when(name == layout.name, value) if out is None else out.when(name == layout.name, value)
        return out

    return let(F.element_at(known, fingerprint(record, layouts)), mapped)


def _items(items: Column, layout: Layout) -> Column:
    return F.transform(items, lambda v: F.struct(_role(v, layout.role).alias("role"), _text(v, layout.text).alias("text")))


def escape(text: Column) -> Column:
    r"""``\`` as ``\s``, ``###`` as ``\h``, ``</turn>`` as ``\t``: afterwards every backslash starts one of these, and
    neither control string is left."""
    out = F.replace(text, F.lit("\\"), F.lit("\\s"))
    return F.replace(F.replace(out, F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\t"))


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\t"), F.lit("</turn>")), F.lit("\\h"), F.lit("###"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def _write(turns: Column) -> Column:
    """The turns in the template. A line break inside a role is escaped as ``\\n``."""
    one = lambda t: F.concat(
        F.lit(HEAD), F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n"), escape(t["text"]), F.lit(END))
    return F.array_join(F.transform(turns, one), "")


def _spans(turns: Column) -> Column:
    """``(start, stop)`` of what the assistant says, in characters of the formatted turns."""
    head = lambda t: F.length(F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n"))) + len(HEAD) + 1
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + head(t)
        stop = begin + F.length(escape(t["text"]))
        span = F.array(F.struct(begin.cast("long").alias("start"), stop.cast("long").alias("stop")))
        return F.struct((stop + len(END)).cast("long").alias("at"),
                        F.when(t["role"] == "assistant", F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda a: a["spans"])


def format_records(records: DataFrame, *, id_col: str = "conv_id", record_col: str = "record", order_col: str | None = None,
                   layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv_id, formatted, loss_spans, n_turns`` of every conversation, and ``n_unknown``, its records of no known layout,
    which have no turns here: ``unknown_records`` returns them whole.

    ``record_col`` is a variant (``parse_json``, ``to_variant_object``). Records of one id form one conversation in the
    order of ``order_col`` (ties and nulls: nulls first, then by role and text); without it every id is one record. Null
    roles and texts are empty; a null id is a conversation of its own. Turns are first written in blocks of neighbouring
    order, so a conversation's last step joins a few long strings instead of all its rows.
    """
    order = F.lit(0).cast("long") if order_col is None else F.col(f"`{order_col}`").cast("long")
    turns = turns_of(F.col("record"), layouts)
    rows = records.select(F.col(f"`{id_col}`").alias("conv_id"), order.alias("turn"), F.col(f"`{record_col}`").alias("record"))
    rows = rows.select("conv_id", "turn", turns.alias("turns"))
    blocks = rows.groupBy("conv_id", F.floor(F.col("turn") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("turn", F.coalesce("turns", F.array().cast(
            "array<struct<role:string,text:string>>")).alias("turns")))).alias("rows"),
        F.count_if(F.col("turns").isNull()).alias("n_unknown"))
    blocks = blocks.select("conv_id", "block", "n_unknown", F.flatten("rows.turns").alias("turns"))
    written = blocks.select("conv_id", "block", "n_unknown", F.size("turns").cast("long").alias("n"),
                            _write(F.col("turns")).alias("text"), _spans(F.col("turns")).alias("spans"))
    upto = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.sum(F.length("text").cast("long")).over(upto) - F.length("text")
    placed = written.withColumn("at", at).withColumn("spans", F.transform("spans", lambda s: F.struct(
        (s["start"] + F.col("at")).alias("start"), (s["stop"] + F.col("at")).alias("stop"))))
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "text", "spans"))).alias("b"),
        F.sum("n").alias("n_turns"), F.sum("n_unknown").alias("n_unknown"))
    return whole.select("conv_id", F.array_join("b.text", "").alias("formatted"), F.flatten("b.spans").alias("loss_spans"),
                        "n_turns", "n_unknown")


def unknown_records(records: DataFrame, *, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The rows whose record has no known layout, whole, with all their columns: what ``format_records`` cannot place."""
    return records.filter(turns_of(F.col(f"`{record_col}`"), layouts).isNull())


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted, END), lambda p: p != "")

    def one(p: Column) -> Column:
        at = F.instr(p, "\n")
        role = F.replace(F.substring(p, len(HEAD) + 1, at - len(HEAD) - 1), F.lit("\\n"), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(F.substr(p, at + 1, F.length(p))).alias("text"))

    return F.transform(parts, one)


def digests(done: DataFrame) -> DataFrame:
    """What the output says, read back from it: ``conv_id``, turns and loss text with their hashes, lengths."""
    said = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substr("formatted", (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.withColumn("turns", read_back(F.col("formatted"))).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        let(said, lambda x: F.struct(F.length(x).cast("long").alias("n"), F.sha2(x, 256).alias("h"))).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", "n_turns", "turns_sha256", F.col("loss.n").alias("loss_chars"), F.col("loss.h").alias("loss_sha256"),
        "formatted_chars")
