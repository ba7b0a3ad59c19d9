"""Document trees as flat node tables: text components, nesting by level, visual components, supplements, preview.

Annotated blocks (doc_id, id, page, type, content, bbox, level, contd, image, source_label) come in; -1 is no link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from leafwright.functions.labels import SUPPLEMENT_TYPES, SUPPLEMENTS
from leafwright.runtime import RUN_LENGTH, cut, fill, fold_sorted, written

#: Types that are no running text.
VISUAL = ("table_footnote", "table", "chart", "table_caption", "image_footnote", "image", "image_caption", "seal")
LARGE = ("super", "list", "ref_block", "equation_block", "image_block")
COMPONENTS = ("table", "chart", "image", "seal", "image_block")
DEFAULT_TITLE = "Default Title"
SPLIT, CONTD = "<|txt_split|>", "<|txt_contd|>"
#: The level that titles without one take when nesting.
DEEPEST = 100


def place(blocks: DataFrame) -> Column:
    """bbox and page of a block as one location; nulls where the table has no such columns."""
    return F.struct(*[F.col(c) if c in blocks.columns else F.lit(None).cast(t).alias(c) for c, t in (("bbox", "array<double>"), ("page", "int"))])


def retyped(blocks: DataFrame) -> DataFrame:
    """Text with a supplement's source label takes the supplement's type; titles without a level are text."""
    table = F.create_map(*[F.lit(x) for kv in SUPPLEMENTS.items() for x in kv])
    kind = F.when((F.col("type") == "text") & table[F.coalesce("source_label", F.lit(""))].isNotNull(), table[F.col("source_label")]).otherwise(F.col("type"))
    return blocks.withColumn("type", kind).withColumn("type", F.when((F.col("type") == "title") & (F.coalesce("level", F.lit(-1)) < 0), "text").otherwise(F.col("type")))


def is_running_text(kind: Column) -> Column:
    return ~kind.isin("title", *VISUAL, *LARGE, *SUPPLEMENT_TYPES)


def _parts(blocks: DataFrame) -> DataFrame:
    """Titles and running text with the id of the title they belong to (0: before the first) and their separator."""
    b = retyped(blocks).withColumns({"content": F.coalesce("content", F.lit("")), "is_title": F.col("type") == "title", "is_text": is_running_text(F.col("type"))}).filter("is_title or is_text")
    own = fill(b, "doc_id", "id", {"title_id": F.when(F.col("is_title"), F.col("id"))}, forward=True, own_row=True)
    # a text is continued if a text at or before it points to it
    targets = b.filter("is_text and contd >= 0").groupBy("doc_id", F.col("contd").alias("id")).agg(F.min("id").alias("by"))
    return own.join(targets, ["doc_id", "id"], "left").withColumns({"title_id": F.coalesce("title_id", F.lit(0)), "mark": F.when(F.col("by") <= F.col("id"), CONTD).otherwise(SPLIT)})


def text_components(blocks: DataFrame) -> DataFrame:
    """doc_id, comp_id (its title's id, 0 for the lead-in), title, content, level, block_ids, locations, n_blocks.

    The texts of a component are joined in order; the lead-in exists if it has a text, or nothing else exists.
    A component is as large as the section; a section is text that one node's content holds.
    """
    p = _parts(blocks)
    entry = F.struct("id", "mark", "content", "is_title", place(p).alias("place"))
    g = p.groupBy("doc_id", "title_id").agg(F.array_sort(F.collect_list(entry)).alias("parts"), F.max(F.when(F.col("is_title"), F.struct("content", "level"))).alias("t"))
    texts = F.filter("parts", lambda x: ~x["is_title"])
    first = F.array_position(F.transform("texts", lambda x: x["content"] != ""), True)  # from there on marks stand between texts
    joined = F.array_join(F.transform("texts", lambda x, i: F.when(i + 1 <= first, x["content"]).otherwise(F.concat(F.when(first > 0, x["mark"]).otherwise(""), x["content"]))), "")
    title = F.coalesce(F.col("t.content"), F.lit(DEFAULT_TITLE))
    out = g.withColumn("texts", texts).select("doc_id", F.col("title_id").alias("comp_id"), title.alias("title"), joined.alias("content"), F.coalesce(F.col("t.level"), F.lit(1)).alias("level"), F.transform("parts", lambda x: x["id"]).alias("block_ids"), F.transform("parts", lambda x: x["place"]).alias("locations"))
    lead_only = out.groupBy("doc_id").agg(F.max("comp_id").alias("most"))
    out = out.join(lead_only, "doc_id").filter((F.col("comp_id") > 0) | (F.col("content") != "") | (F.col("most") == 0)).drop("most")
    return out.withColumn("n_blocks", F.size("block_ids"))


def component_levels(blocks: DataFrame) -> DataFrame:
    """doc_id, comp_id, level of the text components, without their texts: all that nesting needs."""
    flag = F.when(F.coalesce("content", F.lit("")) != "", "x").otherwise("")
    p = _parts(blocks.select("doc_id", "id", "type", "level", "contd", "source_label", flag.alias("content")))
    g = p.groupBy("doc_id", "title_id").agg(F.max(F.when(F.col("is_title"), F.col("level"))).alias("level"), F.bool_or(F.col("is_text") & (F.col("content") != "")).alias("filled"))
    most = g.groupBy("doc_id").agg(F.max("title_id").alias("most"))
    return g.join(most, "doc_id").filter("title_id > 0 or filled or most = 0").select("doc_id", F.col("title_id").alias("comp_id"), F.coalesce("level", F.lit(1)).alias("level"))


def _nesting(level: Column) -> Column:
    return F.when(level > 0, level).otherwise(DEEPEST)


def parents(components: DataFrame, run_length: int = RUN_LENGTH) -> DataFrame:
    """doc_id, comp_id, parent_id, ancestors: the nearest earlier component of a smaller level, -1 is the root; and
    all open components from the root down.

    Open components form a stack of rising levels. Runs of components are folded first, then the runs' stacks
    along the document, then the components with the stack their run began with: no task holds a document.
    """
    c = components.select("doc_id", F.col("comp_id").cast("long").alias("comp_id"), _nesting(F.col("level")).cast("int").alias("lv")).withColumn("run", F.floor(F.col("comp_id") / run_length))

    def push(stack: list, level: int, comp: int) -> None:
        while stack and stack[-1][0] >= level:
            stack.pop()
        stack.append((level, comp))

    def fold_run(state, r):
        if r is None:
            s = state["stack"]
            return [(state["doc"], state["run"], state["least"], [x[0] for x in s], [x[1] for x in s])]
        state.update(doc=r["doc_id"], run=r["run"], least=min(state["least"], r["lv"]))
        push(state["stack"], r["lv"], r["comp_id"])
        return None

    runs = fold_sorted(c, ["doc_id", "run"], ["comp_id"], lambda: {"stack": [], "least": 1 << 30}, fold_run, ["lv"], "doc_id long, run long, least int, levels array<int>, comps array<long>")

    def fold_runs(state, r):
        if r is None:
            return None
        before = [*state]
        state[:] = [x for x in state if x[0] < r["least"]] + list(zip(r["levels"], r["comps"], strict=True))
        return [(r["doc_id"], r["run"], [x[0] for x in before], [x[1] for x in before])]

    starts = fold_sorted(runs, ["doc_id"], ["run"], list, fold_runs, ["least", "levels", "comps"], "doc_id long, run long, levels array<int>, comps array<long>")

    def place(state, r):
        if r is None:
            return None
        if r["levels"] is not None:
            state[:] = list(zip(r["levels"], r["comps"], strict=True))
            return None
        while state and state[-1][0] >= r["lv"]:
            state.pop()
        out = [(r["doc_id"], r["comp_id"], state[-1][1] if state else -1, [x[1] for x in state])]
        state.append((r["lv"], r["comp_id"]))
        return out

    rows = c.withColumns({"levels": F.lit(None).cast("array<int>"), "comps": F.lit(None).cast("array<long>")})
    heads = starts.select("doc_id", F.lit(-1).cast("long").alias("comp_id"), F.lit(0).alias("lv"), "run", "levels", "comps")
    return fold_sorted(rows.unionByName(heads), ["doc_id", "run"], ["comp_id"], list, place, ["lv", "levels", "comps"], "doc_id long, comp_id long, parent_id long, ancestors array<long>")


def visual_components(blocks: DataFrame) -> DataFrame:
    """doc_id, vis_id, type, title, metadata, content, link, block_ids, locations: visual blocks with their captions and footnotes.

    A merged table (merged_ids, merged_locations of `tables.without_parts`) has the ids and places of all its parts.
    """
    b = retyped(blocks).withColumn("content", F.coalesce("content", F.lit("")))
    merged = "merged_ids" in blocks.columns
    ids = F.coalesce("merged_ids", F.array("id")) if merged else F.array("id")
    places = F.coalesce("merged_locations", F.array(place(b))) if merged else F.array(place(b))
    v = b.filter(F.col("type").isin(*COMPONENTS)).select("doc_id", F.col("id").alias("vis_id"), "type", "content", F.col("image").alias("link"), ids.alias("own_ids"), places.alias("own_places"))
    part = F.when(F.col("type").contains("caption"), "c").when(F.col("type").contains("footnote"), "f")
    linked = b.filter((F.col("image") >= 0) & part.isNotNull()).select("doc_id", F.col("image").alias("vis_id"), F.struct("id", part.alias("part"), "content", place(b).alias("place")).alias("x")).groupBy("doc_id", "vis_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    texts = lambda p: F.array_join(F.transform(F.filter("xs", lambda x: (x["part"] == p) & (x["content"] != "")), lambda x: x["content"]), " ")
    return v.join(linked, ["doc_id", "vis_id"], "left").select("doc_id", "vis_id", "type", F.coalesce(texts("c"), F.lit("")).alias("title"), F.coalesce(texts("f"), F.lit("")).alias("metadata"), "content", "link", F.concat("own_ids", F.coalesce(F.transform("xs", lambda x: x["id"]), F.array().cast("array<int>"))).alias("block_ids"), F.concat("own_places", F.coalesce(F.transform("xs", lambda x: x["place"]), F.array().cast("array<struct<bbox: array<double>, page: int>>"))).alias("locations"))


def attached_visuals(blocks: DataFrame, components: DataFrame, visuals: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """doc_id, vis_id, parent_kind (visual, text, root), parent_id.

    A visual whose link is among another visual's blocks is its child; else it goes to the component that holds
    the linked block, or without a link to the nearest title before it. keep_unmatched: those without either go
    to the root, otherwise they are left out.
    """
    held = visuals.select("doc_id", F.col("vis_id").alias("outer"), F.explode("block_ids").alias("link"))
    nested = visuals.filter("link >= 0").select("doc_id", "vis_id", "link").join(held, ["doc_id", "link"]).filter("outer <> vis_id").groupBy("doc_id", "vis_id").agg(F.min("outer").alias("outer"))
    homes = components.select("doc_id", "comp_id", F.explode("block_ids").alias("link"))
    first = visuals.select("doc_id", F.array_min("block_ids").alias("id"), "vis_id", "link")
    titles = retyped(blocks).filter("type = 'title'").select("doc_id", "id", F.col("id").alias("title_id"), F.lit(None).cast("int").alias("vis_id"))
    marks = first.filter("link < 0").select("doc_id", "id", F.lit(None).cast("int").alias("title_id"), "vis_id")
    before = fill(titles.unionByName(marks), "doc_id", "id", {"before": F.col("title_id")}, forward=True).filter("vis_id is not null").select("doc_id", "vis_id", "before")
    v = visuals.select("doc_id", "vis_id", "link").join(nested, ["doc_id", "vis_id"], "left").join(before, ["doc_id", "vis_id"], "left")
    v = v.withColumn("link", F.when(F.col("link") >= 0, F.col("link")).otherwise(F.col("before"))).join(homes, ["doc_id", "link"], "left")
    kind = F.when(F.col("outer").isNotNull(), "visual").when(F.col("comp_id").isNotNull(), "text").otherwise("root")
    out = v.select("doc_id", "vis_id", kind.alias("parent_kind"), F.coalesce("outer", "comp_id", F.lit(-1)).cast("long").alias("parent_id"))
    return out if keep_unmatched else out.filter("parent_kind <> 'root'")


def supplements(blocks: DataFrame) -> DataFrame:
    """doc_id, id, type, title, content, locations: headers, footers and the like, named "Page p - type", later ones with a number."""
    b = retyped(blocks).filter(F.col("type").isin(*SUPPLEMENT_TYPES))
    n = F.row_number().over(Window.partitionBy("doc_id", "page", "type").orderBy("id")) - 1
    name = F.concat(F.lit("Page "), F.col("page"), F.lit(" - "), F.col("type"))
    return b.withColumn("n", n).select("doc_id", "id", "type", F.when(F.col("n") > 0, F.concat(name, F.lit(" - "), F.col("n"))).otherwise(name).alias("title"), F.coalesce("content", F.lit("")).alias("content"), F.array(place(b)).alias("locations"))


def _key(kind: int, number: Column) -> Column:
    return F.concat(F.lit(str(kind)), F.lpad(number.cast("string"), 10, "0"))


def tree(blocks: DataFrame) -> DataFrame:
    """doc_id, node (c: component, v: visual, s: supplement, with its id), parent, path, type, title, metadata, content, level, block_ids, locations.

    level is a title's own, the linked block of a visual (-1: none), -1 for supplements; locations are in step with block_ids. The root has no row and is the parent "root". path holds the sort keys of all ancestors and the node, class (text,
    visual, supplement) and id, so that rows ordered by path are in reading order.
    """
    blocks = written(blocks, "tree_blocks")
    comps = text_components(blocks)
    vis = visual_components(blocks)
    none = F.lit("")
    up = parents(component_levels(blocks))
    path = F.array_join(F.transform(F.concat("ancestors", F.array(F.col("comp_id").cast("long"))), lambda i: _key(0, i)), "/")
    c = comps.join(up, ["doc_id", "comp_id"]).select("doc_id", F.concat(F.lit("c"), "comp_id").alias("node"), F.when(F.col("parent_id") < 0, "root").otherwise(F.concat(F.lit("c"), "parent_id")).alias("parent"), path.alias("path"), F.lit("text").alias("type"), "title", none.alias("metadata"), "content", "level", "block_ids", "locations")
    c = written(c, "tree_components")
    at = cut(attached_visuals(blocks, comps, vis))
    head = F.when(F.col("parent_kind") == "visual", "v").otherwise("c")
    v = vis.join(at, ["doc_id", "vis_id"]).withColumn("parent", F.when(F.col("parent_kind") == "root", "root").otherwise(F.concat(head, "parent_id")))
    v = v.select("doc_id", F.concat(F.lit("v"), "vis_id").alias("node"), "parent", _key(1, F.col("vis_id")).alias("key"), "parent_kind", "type", "title", "metadata", "content", F.col("link").alias("level"), "block_ids", "locations")
    columns = [x for x in c.columns if x != "path"]
    over = c.select("doc_id", F.col("node").alias("parent"), F.col("path").alias("up"))
    placed = v.filter("parent_kind <> 'visual'").join(over, ["doc_id", "parent"], "left").select(*columns, F.concat_ws("/", "up", "key").alias("path"))
    out, inner = placed, v.filter("parent_kind = 'visual'")
    while not inner.isEmpty():  # visuals inside visuals, a round a level; a ring of visuals has no place and ends the loop
        next_ = cut(inner.join(placed.select("doc_id", F.col("node").alias("parent"), F.col("path").alias("up")), ["doc_id", "parent"]).select(*columns, F.concat_ws("/", "up", "key").alias("path")))
        if next_.isEmpty():
            break
        inner = cut(inner.join(next_.select("doc_id", "node"), ["doc_id", "node"], "left_anti"))
        out, placed = out.unionByName(next_), next_
    s = supplements(blocks).select("doc_id", F.concat(F.lit("s"), "id").alias("node"), F.lit("root").alias("parent"), _key(2, F.col("id")).alias("path"), "type", "title", F.col("content").alias("metadata"), "content", F.lit(-1).alias("level"), F.array("id").alias("block_ids"), "locations")
    return c.unionByName(out).unionByName(s)


def preview(nodes: DataFrame, most: int = 30) -> DataFrame:
    """doc_id, path, line: the root's line, then a line per node in reading order: four spaces a level, title, start of the content."""
    c = F.coalesce("content", F.lit(""))
    start = F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)
    lines = nodes.select("doc_id", "path", F.concat(F.expr("repeat('    ', size(split(path, '/')))"), F.coalesce("title", F.lit("")), F.lit("|"), start).alias("line"))
    return lines.unionByName(nodes.select("doc_id", F.lit("").alias("path"), F.lit("|").alias("line")).distinct())
