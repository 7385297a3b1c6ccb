"""Order-dependent text operators: carried state, segmentation, packing.

Order is always within a document, so work is spread by document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import clean_statement, clean_text, trim_u

#: What starts a section and a problem, and words for the kinds of problems.
SECTION = r"(?U)^[一二三四五六七八九十百千]+[、．.]\s*.+题"
NUMBER = r"(?U)^\s*(\d+)\s*[.、．)]\s*"
SUB_QUESTION = r"(?U)^\s*[（(]\s*\d+\s*[）)]\s*"
ITEM = r"(?U)^\(?\s*([0-9]{1,2})\s*\)"


def section_header(c: Column) -> Column:
    return trim_u(c).rlike(SECTION)


def problem_number(c: Column) -> Column:
    """The number that opens a problem, null if none does."""
    return F.nullif(F.regexp_extract(trim_u(c), NUMBER, 1), F.lit(""))


def sub_question(c: Column) -> Column:
    return trim_u(c).rlike(SUB_QUESTION)


def problem_type(section: Column) -> Column:
    s = F.coalesce(section, F.lit(""))
    solve = s.contains("解答") | s.contains("计算") | s.contains("证明") | s.contains("应用")
    return F.when(s.contains("选择"), "choice").when(s.contains("填空"), "fill").when(solve, "solve").otherwise("unknown")


def context_state(lines: DataFrame, doc: str, pos: str, marks: dict[str, Column | Callable[[Column], Column]], practice: tuple[str, str] | None = None) -> DataFrame:
    """Carry stage, domain, theme and section through the lines of a document.

    ``marks``: for each of ``domain, stage, section, theme`` the marker a line
    bears, or null; the first in that order counts (that of a theme may be a
    function of the domain that holds at the line).  A domain or stage resets
    theme and section, not each other.  Marker lines are not kept; others are if
    all four are set.  ``practice``: a domain and the theme it has by default."""
    order = W.partitionBy(doc).orderBy(pos)
    d, st, se, th = (marks[k] for k in ("domain", "stage", "section", "theme"))
    own = lines.withColumns(
        {
            "_d": d,
            "_st": F.when(d.isNull(), st),
            "_se": F.when(d.isNull() & st.isNull(), se),
        }
    )
    run = own.withColumns(
        {
            "stage": F.last("_st", True).over(order),
            "domain": F.last("_d", True).over(order),
            "_reset": F.sum(F.when(F.col("_d").isNotNull() | F.col("_st").isNotNull(), 1).otherwise(0)).over(order),
        }
    )
    run = run.withColumn("_th", F.when(F.coalesce("_d", "_st", "_se").isNull(), th(F.col("domain")) if callable(th) else th))
    inner = W.partitionBy(doc, "_reset").orderBy(pos)
    out = run.withColumns({"section": F.last("_se", True).over(inner), "theme": F.last("_th", True).over(inner)})
    if practice:
        out = out.withColumn("theme", F.when(F.col("theme").isNull() & F.col("domain").eqNullSafe(practice[0]), practice[1]).otherwise(F.col("theme")))
    plain = F.coalesce("_d", "_st", "_se", "_th").isNull()
    return out.where(plain & F.col("stage").isNotNull() & F.col("domain").isNotNull() & F.col("theme").isNotNull() & F.col("section").isNotNull()).drop("_d", "_st", "_se", "_th", "_reset")


def segments(elements: DataFrame, doc: str = "doc", pos: str = "pos") -> DataFrame:
    """Elements with ``problem, number, section``: headers close a problem and are
    left out, a number opens one, other elements go with the open one."""
    own = elements.withColumn("content", F.coalesce(trim_u(F.col("content")), F.lit("")))
    own = own.where((F.col("content") != "") | (F.col("type") == "image"))
    order = W.partitionBy(doc).orderBy(pos)
    own = own.withColumn("_h", (F.col("content") != "") & section_header(F.col("content"))).withColumn("_num", F.when(~F.col("_h"), problem_number(F.col("content"))))
    own = own.withColumn("_start", ~F.col("_h") & (F.col("_num").isNotNull() | F.coalesce(F.lag("_h").over(order), F.lit(True))))
    own = own.withColumns({"problem": F.sum(F.when(F.col("_start"), 1).otherwise(0)).over(order).cast("bigint"), "section": F.last(F.when(F.col("_h"), F.col("content")), True).over(order)})
    first = W.partitionBy(doc, "problem").orderBy(pos)
    return own.where(~F.col("_h")).withColumn("number", F.first("_num").over(first)).drop("_h", "_num", "_start")


def problems(segmented: DataFrame, doc: str = "doc", pos: str = "pos") -> DataFrame:
    """One row for each problem: number, section, type, pages and text."""
    parts = F.when((F.col("type") != "image") & (F.col("content") != ""), F.struct(pos, "content"))
    grouped = segmented.groupBy(doc, "problem").agg(
        F.max("number").alias("number"),
        F.max("section").alias("section"),
        F.array_join(F.transform(F.sort_array(F.collect_set("page")), lambda p: p.cast("string")), ",").alias("page_span"),
        F.countDistinct("page").alias("n_pages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(parts)), lambda x: x["content"]), "\n").alias("text_plain"),
        F.count("*").alias("n_elements"),
    )
    return grouped.withColumn("type", problem_type(F.col("section")))


def chunks(blocks: DataFrame, doc: str, pos: str, text: str, most: int = 1800, page: str | None = None) -> DataFrame:
    """Greedy packing: ``doc, chunk, first, last, n_blocks, n_chars, text``.  A
    block that would pass ``most`` opens the next chunk; one that is longer is
    alone.  Blocks are cleaned once and gathered by document once; a fold over
    them keeps only where chunks begin, and chunks are slices."""
    own = blocks.select(doc, F.struct(F.col(pos).alias("p"), clean_text(F.col(text)).alias("t"), (F.lit(0) if page is None else F.col(page)).alias("g")).alias("x"))
    some = F.array_sort(F.filter(F.collect_list("x"), lambda x: F.coalesce(x["t"], F.lit("")) != ""))
    kind = "struct<done:array<int>,size:bigint,at:int>"
    begin = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("size"), F.lit(0).alias("at")).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        n, at = F.length(x["t"]).cast("bigint"), acc["at"] + 1
        new = (acc["at"] == 0) | (acc["size"] + n > most)
        return F.struct(F.when(new, F.concat(acc["done"], F.array(at))).otherwise(acc["done"]).alias("done"), F.when(new, n).otherwise(acc["size"] + n).alias("size"), at.alias("at")).cast(kind)

    gathered = own.groupBy(doc).agg(some.alias("b"))
    starts = gathered.select(doc, "b", F.aggregate("b", begin, step, lambda acc: acc["done"]).alias("s"))
    slices = F.transform("s", lambda at, k: F.slice("b", at, F.coalesce(F.get("s", k + 1), F.size("b") + 1) - at))
    each = starts.select(doc, F.posexplode(slices).alias("k", "part"))
    parts = lambda f: F.transform("part", lambda x: x[f])
    more = [] if page is None else [F.array_min(parts("g")).alias("first_page"), F.array_max(parts("g")).alias("last_page")]
    return each.select(
        doc,
        (F.col("k") + 1).cast("bigint").alias("chunk"),
        F.array_min(parts("p")).cast("bigint").alias("first"),
        F.array_max(parts("p")).cast("bigint").alias("last"),
        F.size("part").cast("bigint").alias("n_blocks"),
        F.aggregate("part", F.lit(0).cast("bigint"), lambda n, x: n + F.length(x["t"])).alias("n_chars"),
        *more,
        F.array_join(parts("t"), "\n\n").alias("text"),
    )


def ranked(df: DataFrame, store, *order) -> DataFrame:
    """``df`` with ``rank``, its place in the given order, without one task for all:
    rows are sorted by ranges, written, and numbered from the sizes of the ranges
    before theirs.  ``store(df, name)`` writes a table and reads it back."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    low = F.monotonically_increasing_id()
    held = store(dealt.select("*", F.shiftright(low, 33).alias("_range"), F.bitwise_not(F.shiftleft(F.shiftright(low, 33), 33)).bitwiseAND(low).alias("_at")), "ranges")
    sizes = held.groupBy("_range").agg(F.count("*").alias("_n"))
    # one row for each range
    before = sizes.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"))
    return held.join(F.broadcast(before), "_range").withColumn("rank", (F.col("_before") + F.col("_at") + 1).cast("bigint")).drop("_range", "_at", "_before")


def items(lines: DataFrame, doc: str, pos: str, line: str, most: int = 180, least: int = 8) -> DataFrame:
    """Statements of a document: a marker opens an item; cleaned statements that
    are too short go; the rest are numbered.  Documents left without any are cut
    into slices of 180 characters."""
    order = W.partitionBy(doc).orderBy(pos)
    own = lines.withColumn("_item", F.sum(F.when(F.col(line).rlike(ITEM), 1).otherwise(0)).over(order))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(line).alias("t")))), lambda x: x["t"]), "\n")
    each = own.groupBy(doc, "_item").agg(joined.alias("t")).select(doc, "_item", clean_statement(F.col("t"), most).alias("statement")).where(F.length("statement") >= least)
    whole = lines.groupBy(doc).agg(joined.alias("t")).join(each.select(doc).distinct(), doc, "left_anti").select(doc, clean_statement(F.col("t"), 220).alias("t")).where("length(t) > 0")
    slices = whole.select(doc, "t", F.explode(F.sequence(F.lit(0), F.floor((F.length("t") - 1) / 180).cast("int"))).alias("_item"))
    part = F.substr("t", F.col("_item") * 180 + 1, F.lit(180))
    slices = slices.select(doc, F.col("_item").cast("bigint"), part.alias("s")).where(F.length("s") >= least)
    slices = slices.select(doc, "_item", F.concat(F.regexp_replace("s", "[，,、]+$", ""), F.when(F.col("s").endswith("。"), "").otherwise("。")).alias("statement"))
    both = each.unionByName(slices)
    return both.withColumn("n", F.row_number().over(W.partitionBy(doc).orderBy("_item")).cast("bigint")).drop("_item")


def running_headers(blocks: DataFrame, doc: str, page: str, text: str, share: float = 0.6, top: str | None = None, bottom: str | None = None, edge: float = 0.15, store=None) -> DataFrame:
    """Texts that occur more often than ``share`` of the sampled pages of a
    document: all of them, or the first and last 20 of more than 40; none under 3.

    ``top`` and ``bottom``: where a block begins and ends, in heights of its page;
    with them only blocks that reach into the first or last ``edge`` of a page
    count.  With ``store`` (a table is written and read back) pages are numbered
    over all documents, so one with very many pages is no task of its own."""
    pages = blocks.select(doc, page).distinct()
    if store is None:
        rank, total = F.row_number().over(W.partitionBy(doc).orderBy(page)), F.count("*").over(W.partitionBy(doc))
        pages = pages.withColumns({"_r": rank, "_n": total})
    else:
        pages = ranked(pages, store, doc, page)
        sizes = pages.groupBy(doc).agg(F.min("rank").alias("_first"), F.count("*").alias("_n"))
        pages = pages.join(sizes, doc).withColumn("_r", F.col("rank") - F.col("_first") + 1)
    pages = pages.where("_n >= 3 and (_n <= 40 or _r <= 20 or _r > _n - 20)")
    sampled = pages.withColumn("_of", F.least("_n", F.lit(40))).select(doc, page, "_of")
    own = blocks.withColumn(text, clean_text(F.col(text))).where(F.coalesce(text, F.lit("")) != "")
    if top is not None and bottom is not None:
        own = own.where(((F.col(top) < edge) & (F.col(bottom) > 0)) | ((F.col(bottom) > 1 - edge) & (F.col(top) < 1)))
    counts = own.join(sampled, [doc, page]).groupBy(doc, text, "_of").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") / F.col("_of") > share).select(doc, text, "n")


def font_roles(spans: DataFrame, doc: str, size: str, text: str) -> DataFrame:
    """``doc, role, size``: the size of most characters is the body's; the next
    larger ones, by more than 1, are h1 to h3."""
    own = spans.withColumn("_t", trim_u(F.col(text))).where("_t <> ''")
    sizes = own.groupBy(doc, F.round(size, 1).alias("size")).agg(F.sum(F.length("_t")).alias("n"))
    body = sizes.groupBy(doc).agg(F.max_by("size", F.struct("n", "size")).alias("body"))
    larger = sizes.join(body, doc).where("size > body + 1")
    ranked = larger.withColumn("r", F.row_number().over(W.partitionBy(doc).orderBy(F.desc("size")))).where("r <= 3")
    return body.select(doc, F.lit("body").alias("role"), F.col("body").alias("size")).unionByName(ranked.select(doc, F.concat(F.lit("h"), F.col("r").cast("string")).alias("role"), "size"))


def heading_level(size: Column, value: Column, bold: Column, sizes: dict[str, Column]) -> Column:
    """1 to 3 by size; 0 for body text, long lines, sentences and small light lines."""
    level = F.when(size >= sizes["h1"] - 0.5, 1).when(size >= sizes["h2"] - 0.5, 2).when(size >= sizes["h3"] - 0.5, 3).otherwise(0)
    own = trim_u(value)
    sentence = own.rlike("[.。!！?？]$") & ~own.rlike(r"^[\p{Nd}第]+[.、章节]")
    light = (level >= 2) & ~bold & (size < sizes["body"] + 2)
    return F.when((level == 0) | (F.length(own) > 80) | sentence | light, 0).otherwise(level)


def lesson_summary(chunked: DataFrame, by: str) -> DataFrame:
    """Chunk statistics of each backend, lengths to one place; an errored one has nulls."""
    n = F.length("text")
    return chunked.groupBy(by).agg(
        F.count("text").alias("chunks"),
        F.sum(F.when(n <= 24, 1).otherwise(0)).cast("bigint").alias("short_chunks"),
        F.round(F.avg(n), 1).alias("avg_chars"),
        F.min(n).cast("bigint").alias("min_chars"),
        F.max(n).cast("bigint").alias("max_chars"),
    )
