"""Entity trees of any depth read with native expressions, without Python workers.

A document is dealt and sorted once, whole. It is cut into runs: end tags that follow each other, or
a start tag with the elements without child elements behind it. A fold over its runs carries the open
elements, each with its path and the number of its children so far, so a run needs no look at
what came before it and all its elements share one path. Runs are cut into elements where rows are
made. Depth is not known beforehand: no pass over the documents looks for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countermill.functions.text import unescape_xml
from countermill.sources.node_models import MODEL_COLUMNS

# Quoted values may hold angle brackets. Groups are repeated possessively: their parts exclude each other,
# so there is nothing to try again, and no stack is needed for each repetition.
WITHIN = r"""[^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*+"""
TAG = f"<{WITHIN}>"
BLANK = r" \t\n\x0B\f\r"
ELEMENT = f"<(?![!?]){WITHIN}>"
# Comments, CDATA sections, instructions and declarations, and texts that hold them.
ASIDE = rf"<(?:!--[\s\S]*?-->|!\[CDATA\[[\s\S]*?\]\]>|\?[\s\S]*?\?>|![A-Za-z][^>]*>|[!?]{WITHIN}>)"
PIECE = rf"{ASIDE}|[^<]+(?:{ELEMENT}[^<]*)*+|(?:{ELEMENT}[^<]*)++|<"
MIXED = rf"[^<]*(?:{ASIDE}[^<]*)*+"


def _leaf(group: int, text: str) -> str:
    """An element without child elements and the text behind it; its name is the ``group`` of the expression."""
    name = rf"""(?:([^{BLANK}/<>"']+)(?=[{BLANK}>]))?+"""
    return rf"<(?![!?/]){name}{WITHIN}>(?:(?<=/>)|{text}</\{group}[{BLANK}]*>){text}"


TOKEN = rf"{_leaf(1, '[^<]*')}|{TAG}[^<]*|[^<]+|<"
RUN = (
    rf"(?:</{WITHIN}>{MIXED})++|(?:{_leaf(1, MIXED)})++|{ELEMENT}{MIXED}(?:{_leaf(2, MIXED)})*+|"
    rf"[^<]+(?:{ASIDE}[^<]*)*+|(?:{ASIDE}[^<]*)++|<"
)
ATTRIBUTE = rf"""[^{BLANK}=<>"'/]++[{BLANK}]*+=[{BLANK}]*+(?:"[^"]*"|'[^']*')"""
BLANKS = r"[\s\x{FEFF}]+"

# A fold copies what it holds at each step, so rows of a long document are collected by few runs, then by
# few of those blocks and so on.
BLOCKS = (16384, 1024, 64, 8)

# The tags that structure a tree.
GROUP, REFERENCE = "Components", "EntityRef"

OPEN, CLOSE, SINGLE, TEXT = "open", "close", "single", "text"


def _literal(text: str) -> Column:
    return F.lit(text)


def _code_points(text: Column) -> Column:
    """Numeric character references replaced by their characters."""

    def decoded(part: Column) -> Column:
        number = F.regexp_extract(part, "^(x[0-9a-fA-F]{1,6}|[0-9]{1,7});", 1)
        point = F.when(number.startswith("x"), F.conv(F.substr(number, F.lit(2)), 16, 10)).otherwise(number).cast("int")
        character = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        rest = F.substr(part, F.length(number) + 2)
        return F.when(number == "", F.concat(_literal("&#"), part)).otherwise(F.concat(character, rest))

    parts = F.split(text, "&#")
    later = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    return F.when(text.contains("&#"), F.concat(F.get(parts, F.lit(0)), F.array_join(later, ""))).otherwise(text)


def _decoded(text: Column) -> Column:
    """Text of the markup, with character references as the characters they stand for."""
    named = {"&lt;": "<", "&gt;": ">", "&apos;": "'", "&quot;": '"', "&amp;": "&"}
    plain = reduce(lambda t, n: F.replace(t, F.lit(n), F.lit(named[n])), named, _code_points(text))
    return F.when(text.contains("&"), plain).otherwise(text)


def _plain_markup(text: Column) -> Column:
    """Markup of tags and texts alone: comments and instructions gone, CDATA as escaped text."""

    def plain(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(10), F.length(piece) - 12)
        escaped = F.replace(F.replace(inner, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        passed_over = piece.startswith("<!") | piece.startswith("<?")
        return F.when(piece.startswith("<![CDATA["), escaped).when(passed_over, F.lit("")).otherwise(piece)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), plain), "")


def _quoted(token: Column, name: str) -> Column:
    return F.regexp_extract(token, rf"""\s{name}\s*=\s*("[^"]*"|'[^']*')""", 1)


def _within(quoted: Column) -> Column:
    return F.when(quoted != "", F.substr(quoted, F.lit(2), F.length(quoted) - 2))


def _start(token: Column) -> Column:
    return F.regexp_extract(token, f"^{TAG}", 0)


def _tag(token: Column) -> Column:
    return F.regexp_extract(token, r"^</?([^\s/>]+)", 1)


def _behind_leaf(rest: Column) -> Column:
    end = F.substring_index(rest, "</", -1)
    return F.substr(end, F.locate(">", end) + 1)


def _tokens(text: Column) -> Column:
    """Start tags, end tags and elements without child elements in order, each with the text behind it."""
    return F.regexp_extract_all(_plain_markup(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def _dealt(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, _markup), documents dealt to tasks by their key."""
    spark = documents.sparkSession
    # Markup is many times its shuffled size, so partitions are not sized by that.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return documents.select(F.col(key).alias("doc"), F.col(text).alias("_markup")).repartition(parts, "doc")


def tree_tokens(documents: DataFrame, key: str, text: str = "value") -> DataFrame:
    """(doc, pos, kind, token, tag, inner, behind, running): tags of each document in order, with the
    number of elements open after each. ``inner`` is the text right after a start tag, ``behind`` that
    after an end; an element without child elements is one ``single`` token. ``text`` tokens are
    those at no tag.
    """
    dealt = _dealt(documents, key, text)
    tokens = dealt.select("doc", F.posexplode_outer(_tokens(F.col("_markup"))).alias("pos", "piece"))
    tokens = tokens.select("doc", "pos", "piece", _start(F.col("piece")).alias("token"))
    tokens = tokens.select("*", F.substr("piece", F.length("token") + 1).alias("rest"))
    token, rest = F.col("token"), F.col("rest")
    leaf = rest.contains("</") & token.startswith("<")
    kind = (
        F.when(F.coalesce(token, F.lit("")) == "", TEXT)
        .when(token.startswith("</"), CLOSE)
        .when(token.endswith("/>") | leaf, SINGLE)
        .otherwise(OPEN)
    )
    tagged = tokens.select(
        "doc",
        "pos",
        kind.alias("kind"),
        F.when(token == "", F.col("piece")).otherwise(token).alias("token"),
        _tag(F.col("token")).alias("tag"),
        F.when(leaf, F.substring_index(rest, "</", 1)).when(kind == OPEN, rest).alias("inner"),
        F.when(leaf, _behind_leaf(rest)).when(kind != OPEN, rest).alias("behind"),
    )
    step = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    so_far = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    return tagged.withColumn("running", F.sum(step).over(so_far).cast("int"))


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, with ``value`` evaluated once and, unlike by an array's transform, not copied."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda known, _: known, of)


def _interleaved(copies: Column) -> Column:
    """Markup of documents with the same key: their first tokens, their second ones and so on. A document
    without tokens leaves none, as it is faulty."""

    def at(tokens: Column) -> Column:
        places = F.sequence(F.lit(0), F.array_max(F.transform(tokens, F.size)) - 1)
        return F.flatten(F.transform(places, lambda i: F.filter(F.transform(tokens, lambda t: F.get(t, i)), F.isnotnull)))

    def joined(tokens: Column) -> Column:
        return F.when(F.exists(tokens, lambda t: F.size(t) == 0), F.lit("")).otherwise(F.array_join(at(tokens), ""))

    return _let(F.transform(copies, _tokens), joined)


def _whole_documents(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, markup): one row for each key."""
    # Ordered by their key, so documents are sorted once.
    of_key = W.partitionBy("doc").orderBy("doc").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    dealt = _dealt(documents, key, text).select(
        "doc",
        F.collect_list(F.coalesce("_markup", F.lit(""))).over(of_key).alias("_copies"),
        F.row_number().over(W.partitionBy("doc").orderBy("doc")).alias("_nth"),
    )
    markup = F.when(F.size("_copies") > 1, _interleaved(F.col("_copies"))).otherwise(F.get("_copies", F.lit(0)))
    return dealt.filter("_nth = 1").select("doc", markup.alias("markup"))


def _behind(token: Column) -> Column:
    """Text behind the end of a token."""
    rest = F.substr(token, F.length(_start(token)) + 1)
    return F.when(rest.contains("</"), _behind_leaf(rest)).otherwise(rest)


def _run(piece: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a run of tokens as (kind, tag, start, first, tokens, properties): ``first`` is the token that opens an element,
    ``start`` its tag and ``tag`` its name; ``tokens`` are the others, ``properties`` those of them that are no group."""
    no_group = lambda t: ~(t.startswith(f"<{GROUP}") & (_tag(t) == GROUP))

    def cut(plain: Column) -> Column:
        return _let(F.regexp_extract_all(plain, F.lit(TOKEN), F.lit(0)), lambda tokens: begun(plain, tokens, F.get(tokens, F.lit(0))))

    def begun(plain: Column, tokens: Column, first: Column) -> Column:
        return _let(_start(F.coalesce(first, F.lit(""))), lambda start: told(plain, tokens, first, start))

    def told(plain: Column, tokens: Column, first: Column, start: Column) -> Column:
        is_leaf = start.endswith("/>") | F.substr(first, F.length(start) + 1).contains("</")
        kind = F.when(start == "", TEXT).when(start.startswith("</"), CLOSE).when(is_leaf, SINGLE).otherwise(OPEN)
        return _let(kind, lambda k: parted(plain, tokens, first, start, k))

    def parted(plain: Column, tokens: Column, first: Column, start: Column, kind: Column) -> Column:
        has_groups = F.substr(plain, F.lit(2)).contains(f"<{GROUP}") | ((kind == SINGLE) & plain.startswith(f"<{GROUP}"))

        def filled(others: Column) -> Column:
            properties = F.when(has_groups, F.filter(others, no_group)).otherwise(others)
            fields = {"kind": kind, "tag": F.when(kind == OPEN, _tag(start)), "start": start, "first": first}
            parts = fields | {"tokens": others, "properties": properties}
            return _let(F.struct(*[c.alias(name) for name, c in parts.items()]), of)

        return _let(F.when(kind == OPEN, F.slice(tokens, 2, F.size(tokens))).otherwise(tokens), filled)

    has_aside = piece.contains("<!") | piece.contains("<?")
    return _let(F.when(has_aside, _plain_markup(piece)).otherwise(piece), cut)


# An open element. Children of a group (and the root) are entities, those of an entity its properties and
# groups. ``path`` is that of an entity; of a group, what comes before the names of its entities.
FRAME = (
    "tag STRING, is_group BOOLEAN, given BOOLEAN, model STRING, path STRING, parent_path STRING, section STRING, name STRING,"
    "place INT, children INT, properties INT"
)
# Elements without child elements that give rows: entities of a group from ``place`` on, or properties of
# an entity from ``number`` on; without tokens, the entity itself as it has no property.
ENTRY = (
    "model STRING, path STRING, parent_path STRING, section STRING, name STRING, place INT, number INT,"
    "are_entities BOOLEAN, tokens ARRAY<STRING>"
)
FRAMES, ENTRIES = f"ARRAY<STRUCT<{FRAME}>>", f"ARRAY<STRUCT<{ENTRY}>>"


def _struct(ddl: str, values: dict[str, Column]) -> Column:
    return F.struct(*[values[name].alias(name) for name in (field.split()[0] for field in ddl.split(","))])


def _frame(of: Column, **changed: Column) -> Column:
    return _struct(FRAME, {field.split()[0]: of[field.split()[0]] for field in FRAME.split(",")} | changed)


def _state(frames: Column, entries: Column, fault: Column) -> Column:
    return F.struct(frames.alias("frames"), entries.alias("entries"), F.coalesce(fault, F.lit(True)).alias("fault"))


def _last(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def _entry(of: Column, tokens: Column) -> Column:
    """Elements below the open element ``of``, which has counted none of them yet."""
    place = F.when(of["is_group"], of["children"]).otherwise(of["place"])
    same = {name: of[name] for name in ["model", "path", "parent_path", "section", "name"]}
    values = {"place": place, "number": of["properties"]}
    return _struct(ENTRY, same | values | {"are_entities": of["is_group"], "tokens": tokens})


def _with_entry(state: Column, condition: Column, entry: Column) -> Column:
    return F.when(condition, F.array_append(state["entries"], entry)).otherwise(state["entries"])


def _inside(state: Column, text: Column) -> Column:
    """True where no text but blanks stands outside of the root."""
    blank = F.trim(F.regexp_replace(text, BLANKS, "")) == ""
    return F.when(F.size(state["frames"]) == 1, blank).otherwise(F.lit(True))


def _opened(of: Column, run: Column) -> Column:
    """The element that a run opens below the open element ``of``."""
    none = {"children": F.lit(0), "properties": F.lit(0)}

    def entity(name: Column) -> Column:
        path = F.concat(of["path"], F.coalesce(name, F.lit("")))
        model = F.when(of["parent_path"].isNull(), name).otherwise(of["model"])
        own = {"is_group": F.lit(False), "model": model, "path": path, "name": name, "place": of["children"]}
        return _frame(of, tag=run["tag"], **own, **none)

    def group(section: Column) -> Column:
        path = F.concat(of["path"], F.lit("/"), section, F.lit(":"))
        given = of["given"] & (run["tag"] == GROUP)
        above = {"path": path, "parent_path": of["path"], "section": section, "name": F.lit(None).cast("string")}
        return _frame(of, tag=run["tag"], is_group=F.lit(True), given=given, place=F.lit(0), **above, **none)

    value = lambda name: _let(_let(_quoted(run["start"], name), _within), _decoded)
    as_group = _let(F.coalesce(value("section"), F.lit("")), group)
    return F.when(of["is_group"], _let(value("name"), entity)).otherwise(as_group)


def _with_leaves(state: Column, below: Column, of: Column, run: Column) -> Column:
    """The state with the leaves of a run below its innermost open element ``of``; ``below`` are the others."""
    tokens = F.when(of["is_group"], run["tokens"]).otherwise(run["properties"])
    gives = of["given"] & (of["is_group"] | (of["tag"] != REFERENCE)) & (F.size(tokens) > 0)
    counted = _frame(
        of, children=of["children"] + F.size(run["tokens"]), properties=of["properties"] + F.size(run["properties"])
    )
    return _state(F.array_append(below, counted), _with_entry(state, gives, _entry(of, tokens)), F.lit(False))


def _after_open(state: Column, run: Column) -> Column:
    def below(of: Column) -> Column:
        is_property = run["tag"] != GROUP
        gives = F.when(of["is_group"], run["tag"] == REFERENCE).otherwise(is_property & (of["tag"] != REFERENCE))
        counted = _frame(of, children=of["children"] + 1, properties=of["properties"] + is_property.cast("int"))
        entries = _with_entry(state, of["given"] & gives, _entry(of, F.array(run["first"])))
        frames = F.array_append(F.slice(state["frames"], 1, F.size(state["frames"]) - 1), counted)
        after = _state(frames, entries, F.lit(False))
        return _let(after, lambda s: _let(_opened(of, run), lambda element: _with_leaves(s, s["frames"], element, run)))

    return _let(_last(state["frames"]), below)


def _after_leaves(state: Column, run: Column) -> Column:
    below = F.slice(state["frames"], 1, F.size(state["frames"]) - 1)
    after = _let(_last(state["frames"]), lambda of: _with_leaves(state, below, of, run))
    return F.when(_inside(state, _behind(_last(run["tokens"]))), after).otherwise(_faulty(state))


def _after_close(state: Column, run: Column) -> Column:
    left = F.size(state["frames"]) - F.size(run["tokens"])

    def ended(closed: Column) -> Column:
        same = F.transform(closed, lambda f: f["tag"]) == F.reverse(F.transform(run["tokens"], _tag))
        is_empty = lambda f: ~f["is_group"] & f["given"] & (f["properties"] == 0) & (f["tag"] != REFERENCE)
        as_entries = F.transform(F.filter(closed, is_empty), lambda f: _entry(f, F.lit(None).cast("array<string>")))
        entries = F.when(F.exists(closed, is_empty), F.concat(state["entries"], as_entries)).otherwise(state["entries"])
        after = _state(F.slice(state["frames"], 1, left), entries, ~same)
        return _let(after, lambda s: F.when(_inside(s, _behind(_last(run["tokens"]))), s).otherwise(_faulty(s)))

    known = _let(F.slice(state["frames"], left + 1, F.size(run["tokens"])), ended)
    return F.when(left < 1, _faulty(state)).otherwise(known)


def _faulty(state: Column) -> Column:
    return _state(state["frames"], state["entries"], F.lit(True))


def _after(state: Column, piece: Column) -> Column:
    """The state after a run of tokens."""
    return F.when(state["fault"], state).otherwise(_run(piece, lambda run: _after_run(state, run)))


def _after_run(state: Column, run: Column) -> Column:
    text = F.coalesce(run["first"], F.lit(""))
    is_text = ~text.startswith("<") & _inside(state, text)
    return (
        F.when(run["kind"] == OPEN, _after_open(state, run))
        .when(run["kind"] == CLOSE, _after_close(state, run))
        .when(run["kind"] == SINGLE, _after_leaves(state, run))
        .when((run["kind"] == TEXT) & is_text, state)
        .otherwise(_faulty(state))
    )


def _walked(markup: Column, result: Callable[[Column, Column], Column]) -> Column:
    """``result`` of the entries of a document and of its fault."""
    none, nothing = F.lit(None).cast("string"), F.lit(0)
    document = {"tag": F.lit(""), "is_group": F.lit(True), "given": F.lit(True), "path": F.lit("")}
    unknown = dict.fromkeys(["model", "parent_path", "section", "name"], none)
    root = _struct(FRAME, document | unknown | dict.fromkeys(["place", "children", "properties"], nothing))
    state_type = f"STRUCT<frames: {FRAMES}, entries: {ENTRIES}, fault: BOOLEAN>"

    def folded(state: Column, pieces: Column, blocks: Sequence[int]) -> Column:
        begin = _state(state["frames"], F.array().cast(ENTRIES), state["fault"]).cast(state_type)
        if not blocks:
            return F.aggregate(pieces, begin, _after)
        numbers = F.sequence(F.lit(0), F.floor(F.size(pieces) / blocks[0]).cast("int"))

        def block(state: Column, number: Column) -> Column:
            found = folded(state, F.slice(pieces, number * blocks[0] + 1, F.lit(blocks[0])), blocks[1:])
            return _let(found, lambda s: _state(s["frames"], F.concat(state["entries"], s["entries"]), s["fault"]))

        return F.aggregate(numbers, begin, block)

    def whole(state: Column) -> Column:
        unfinished = (F.size(state["frames"]) != 1) | (F.get(state["frames"], F.lit(0))["children"] != 1)
        return result(state["entries"], state["fault"] | unfinished)

    begin = _state(F.array(root), F.array().cast(ENTRIES), F.lit(False))
    pieces = F.regexp_extract_all(markup, F.lit(RUN), F.lit(0))
    return _let(pieces, lambda found: _let(begin, lambda state: _let(folded(state, found, BLOCKS), whole)))


def _attributes(start: Column) -> Column:
    """All attributes but the name, as they stand in the start tag of a reference."""
    found = F.regexp_extract_all(F.substr(start, F.lit(len(REFERENCE) + 2)), F.lit(ATTRIBUTE), F.lit(0))
    return F.filter(found, lambda a: ~(a.startswith("name") & a.rlike(r"^name\s*=")))


def tree_rows(documents: DataFrame, key: str, text: str = "value") -> DataFrame:
    """Entity-tree documents as property rows of any depth, with ``doc``, the document's key.

    The rows of :func:`countermill.sources.node_models.model_rows`, made without Python workers.
    ``key`` must tell documents apart. A document that is not well-formed gives no rows, see
    :func:`faulty_trees`; an entity without a name has an empty one in its path.
    """
    found = _walked(F.col("markup"), lambda entries, fault: F.when(~fault, entries))
    entries = _whole_documents(documents, key, text).select("doc", F.inline(found))
    is_entity = F.col("are_entities")
    given = [c for c in entries.columns if c != "tokens"]
    elements = entries.select(*given, F.posexplode_outer("tokens").alias("_at", "_token"))
    # One step at a time: what is read more than once is a column.
    started = elements.withColumn("_start", _start(F.col("_token")))
    # Text of a property stands up to its end or its first child element.
    inner = F.when(~F.col("_start").endswith("/>"), F.substring_index(F.substr("_token", F.length("_start") + 1), "<", 1))
    read = started.withColumns({
        "_quoted": F.when(is_entity, _quoted(F.col("_start"), "name")),
        "_tag": F.when(~is_entity, _tag(F.col("_start"))),
        "_inner": F.when(~is_entity, inner),
        "_is_reference": is_entity & F.col("_start").startswith(f"<{REFERENCE}") & (_tag(F.col("_start")) == REFERENCE),
    }).withColumn("_within", _within(F.col("_quoted"))).withColumn("_name", _decoded(F.col("_within")))
    at_root = is_entity & F.col("parent_path").isNull()
    named = read.select(
        "doc",
        F.when(at_root, F.col("_name")).otherwise(F.col("model")).alias("model"),
        F.when(is_entity, F.concat("path", F.coalesce("_name", F.lit("")))).otherwise(F.col("path")).alias("path"),
        "parent_path",
        "section",
        F.when(is_entity, F.col("_name")).otherwise(F.col("name")).alias("name"),
        F.when(is_entity, F.col("place") + F.col("_at")).otherwise(F.col("place")).alias("entity_pos"),
        F.when(~is_entity, F.col("number") + F.col("_at")).alias("_number"),
        "_tag",
        "_inner",
        F.posexplode_outer(F.when(F.col("_is_reference"), _attributes(F.col("_start")))).alias("_nth", "_attribute"),
    )
    blanks = F.lit(" \t\n\x0b\f\r")
    listed = named.select(
        *[c for c in named.columns if c not in ("_number", "_nth", "_tag", "_attribute")],
        F.coalesce("_number", "_nth", F.lit(0)).alias("prop_pos"),
        F.coalesce("_tag", F.rtrim(F.substring_index("_attribute", "=", 1), blanks)).alias("prop"),
        F.ltrim(F.substr("_attribute", F.locate("=", F.col("_attribute")) + 1), blanks).alias("_quoted"),
    )
    texts = listed.withColumn("_text", F.coalesce("_inner", _within(F.col("_quoted"))))
    values = texts.withColumn("_value", F.coalesce(_decoded(F.col("_text")), F.lit("")))
    value = F.when(F.col("_value").contains("&"), unescape_xml("_value")).otherwise(F.col("_value"))
    return values.select("doc", *MODEL_COLUMNS[:6], "prop_pos", "prop", F.when(F.col("prop").isNotNull(), value).alias("value"))


def faulty_trees(documents: DataFrame, key: str, text: str = "value") -> DataFrame:
    """``doc`` of documents that are not well-formed, empty and NULL ones too."""
    fault = _walked(F.col("markup"), lambda _, fault: fault)
    return _whole_documents(documents, key, text).select("doc", fault.alias("_fault")).filter("_fault").select("doc")


def scan_tree_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Entity-tree files as property rows; ``doc`` is the file."""
    files = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    return tree_rows(files.select(F.col("_metadata.file_path").alias("source_file"), "value"), "source_file")
