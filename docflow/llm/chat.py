"""Chat records of many layouts as canonical turns and training text (dealt operator 7).

The field paths of a record, nested ones too, are hashed; the fingerprint picks
a declarative mapping from ``LAYOUTS``. Turns are written with control strings
around them. Inside roles and texts a backslash goes behind each ``<``, ``[``
and backslash, so no control string of this or another template survives there,
and taking it away again restores the text exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import fresh

BEGIN, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
CHUNK_TURNS = 64


@dataclass(frozen=True)
class Layout:
    """How records with certain field paths become turns.

    ``turns`` lists (role, paths) for records with fields of their own, where a
    role that starts with ``$`` is a path; ``items`` is (list path, role field,
    text field) for records with a list of messages. ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def path_sets(self) -> list[list[str]]:
        some = [c for n in range(len(self.optional) + 1) for c in combinations(self.optional, n)]
        return [sorted({*self.paths, *extra}) for extra in some]


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}

LAYOUTS = (
    Layout("turn", ("role", "text"), turns=(("$.role", ("$.text",)),)),
    Layout(
        "messages", ("messages", "messages[].content", "messages[].role"), items=("messages", "role", "content")
    ),
    Layout(
        "conversations",
        ("conversations", "conversations[].from", "conversations[].value"),
        items=("conversations", "from", "value"),
        roles=SPEAKERS,
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        turns=(("system", ("$.system",)), ("user", ("$.instruction", "$.input")), ("assistant", ("$.output",))),
        optional=("input", "system"),
    ),
    Layout(
        "prompt",
        ("completion", "prompt"),
        turns=(("system", ("$.system",)), ("user", ("$.prompt",)), ("assistant", ("$.completion",))),
        optional=("system",),
    ),
    Layout(
        "question",
        ("answer", "question"),
        turns=(("system", ("$.system",)), ("user", ("$.question", "$.context")), ("assistant", ("$.answer",))),
        optional=("context", "system"),
    ),
)


def field_paths(record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Sorted paths of a variant that any layout knows: fields, and fields of the first item of lists."""
    known = sorted({p for layout in layouts for paths in layout.path_sets() for p in paths})
    lists = sorted({p.split("[]")[0] for p in known if "[]" in p})

    def keys(path: str) -> Column:
        found = F.map_keys(F.try_variant_get(record, path, "map<string,variant>"))
        return F.coalesce(found, F.array().cast("array<string>"))

    def below(name: str) -> Column:
        return F.transform(keys(f"$.{name}[0]"), lambda key: F.concat(F.lit(f"{name}[]."), key))

    every = F.concat(keys("$"), *map(below, lists))
    return F.array_sort(F.array_intersect(every, F.array(*map(F.lit, known))))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, ","))


def layout_of(paths: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Name of the layout by fingerprint; else the first whose paths are all there; else null."""
    exact, loose = [], []
    for layout in layouts:
        shapes = [fingerprint(F.array(*map(F.lit, p))) for p in layout.path_sets()]
        exact.append(F.when(fingerprint(paths).isin(*shapes), layout.name))
        needed = F.array(*map(F.lit, layout.paths))
        loose.append(F.when(F.size(F.array_except(needed, paths)) == 0, layout.name))
    return F.coalesce(*exact, *loose)


def _text(record: Column | str, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def _turns(record: str, layout: Layout) -> Column:
    def turn(role: Column, text: Column) -> Column:
        for known, name in layout.roles.items():
            role = F.when(role == known, name).otherwise(role)
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if layout.items:
        at, role, text = layout.items
        found = F.try_variant_get(record, f"$.{at}", "array<variant>")
        listed = F.transform(found, lambda v: turn(_text(v, f"$.{role}"), _text(v, f"$.{text}")))
        return F.coalesce(listed, F.array().cast("array<struct<role:string,text:string>>"))
    out = []
    for role, paths in layout.turns:
        # Parts that are absent or empty leave no gap; an optional turn may be absent.
        parts = F.filter(F.array(*(_text(record, p) for p in paths)), lambda p: p.isNotNull() & (p != ""))
        said = turn(_text(record, role) if role.startswith("$") else F.lit(role), F.array_join(parts, "\n\n"))
        needed = any(p.removeprefix("$.") in layout.paths for p in paths)
        out.append(said if needed else F.when(F.size(parts) > 0, said))
    return F.array_compact(F.array(*out))


def canonical_turns(df: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """A row for each turn of the records in variant column ``record``, which is replaced.

    Adds ``layout``, ``position`` (from 0), ``role`` and ``text``; other columns
    stay, and a clash is solved by underscores. A null role or text is empty.
    Records of no known layout, null ones too, give one row with nulls in all
    four, so that nothing is lost unseen. Fields that no layout knows are ignored.
    """
    rest = df.drop(record)
    layout, position, role, text = fresh(df, "layout", "position", "role", "text")
    paths, name, turns = fresh(df, "paths", "name", "turns")
    shaped = df.withColumn(paths, field_paths(record, layouts))
    shaped = shaped.withColumn(name, layout_of(F.col(paths), layouts))
    chosen = F.coalesce(*(F.when(F.col(name) == item.name, _turns(record, item)) for item in layouts))
    listed = shaped.select(*rest.columns, F.col(name).alias(layout), chosen.alias(turns))
    return listed.select(
        *rest.columns, layout, F.posexplode_outer(turns).alias(position, turns)
    ).select(
        *rest.columns, layout, position, F.col(f"{turns}.role").alias(role), F.col(f"{turns}.text").alias(text)
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def format_conversations(
    turns: DataFrame, conv: str, order: list[str], role: str = "role", text: str = "text"
) -> DataFrame:
    """A row for each conversation: ``formatted`` and the ``loss_spans`` of its turns.

    Turns are ordered by the ``order`` columns, nulls first, then by role and
    text; equal rows stay repeated. A null role or text is empty. A span is
    (begin, end) in code points from the start of its turn in ``formatted``, and
    is empty for turns that carry no loss. Rows with a null ``conv`` are one
    conversation. The first order column cuts long conversations into chunks,
    which are put together before the whole. No turns give no rows.
    """
    said = F.coalesce(text, F.lit(""))
    who = F.coalesce(role, F.lit(""))
    head = F.concat(F.lit(BEGIN), escape(who), F.lit(MIDDLE))
    body = escape(said)
    loss = who == LOSS_ROLE
    begin = F.length(head)
    item = F.struct(
        *order,
        who.alias("who"),
        said.alias("said"),
        F.concat(head, body, F.lit(END)).alias("piece"),
        F.struct(
            F.when(loss, begin).otherwise(0).alias("begin"),
            F.when(loss, begin + F.length(body)).otherwise(0).alias("end"),
        ).alias("span"),
    )
    chunk = F.floor(F.col(order[0]) / CHUNK_TURNS)
    chunks = (
        turns.groupBy(F.col(conv), chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select(
            conv,
            F.struct(
                "chunk",
                F.array_join("items.piece", "").alias("formatted"),
                F.col("items.span").alias("spans"),
            ).alias("part"),
        )
    )
    whole = chunks.groupBy(conv).agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return whole.select(
        conv,
        F.array_join("parts.formatted", "").alias("formatted"),
        F.flatten("parts.spans").alias("loss_spans"),
    )


def read_back(formatted: DataFrame, conv: str) -> DataFrame:
    """What training sees of formatted conversations: ``turns`` and the text under the loss mask."""
    cut = F.split("formatted", END.replace("|", r"\|"))
    pieces = F.slice(cut, F.lit(1), F.size(cut) - 1)
    parsed = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring(F.substring_index(p, MIDDLE, 1), len(BEGIN) + 1, 1 << 30)).alias("role"),
            unescape(F.substring_index(p, MIDDLE, -1)).alias("text"),
        ),
    )
    masked = F.zip_with(
        pieces, "loss_spans", lambda p, s: F.substring(p, s["begin"] + 1, s["end"] - s["begin"])
    )
    return formatted.select(
        conv,
        "formatted",
        parsed.alias("turns"),
        unescape(F.array_join(masked, "")).alias("loss_text"),
    )


def conversation_digest(parsed: DataFrame, conv: str) -> DataFrame:
    """Counts and digests of conversations that were read back."""
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
