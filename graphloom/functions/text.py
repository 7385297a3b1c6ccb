"""Text and coercion functions as column expressions.

White space is Unicode white space throughout; a missing, null or blank value
is the same as no value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Subjects and stages with slugs of their own, and numerals.
SUBJECT_SLUGS = {"科学": "science", "物理": "physics", "化学": "chemistry", "生物": "biology", "数学": "math", "语文": "chinese", "英语": "english", "地理": "geography", "历史": "history", "道德与法治": "morality-law", "信息技术": "it"}
STAGE_SLUGS = {"小学": "elementary", "初中": "middle", "高中": "high", "大学": "university"}
NUMERALS = "一二三四五六七八九"
#: Edge types whose ends can be swapped.
SYMMETRIC = ("confuses_with", "related_to", "same_as")


def trim_u(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def text(c: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(trim_u(c.cast("string")), F.lit(""))


def first_text(*values: Column) -> Column:
    """The first value with text in it, trimmed, or the empty text."""
    return F.coalesce(*(text(v) for v in values), F.lit(""))


def slug_base(c: Column) -> Column:
    out = F.lower(trim_u(F.coalesce(c, F.lit(""))))
    out = F.regexp_replace(out, r"(?U)[\s_/|:;,.()\[\]{}]+", "-")
    out = F.regexp_replace(out, r"[^0-9a-z\-一-鿿]+", "")
    return F.regexp_replace(F.regexp_replace(out, "-+", "-"), "^-|-$", "")


def slugify(c: Column) -> Column:
    """Lower-case words joined by hyphens; of nothing, a stub of the raw value's hash."""
    base = slug_base(c)
    return F.when(base != "", base).otherwise(F.substring(F.sha1(F.coalesce(c, F.lit("None"))), 1, 12))


def mapped(c: Column, table: dict[str, str]) -> Column:
    """The value of ``table`` for ``c``, null if it has none."""
    if not table:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c)


def normalize_slug(c: Column, table: dict[str, str] | None = None, fallback: str = "") -> Column:
    own = text(c)
    lowered = F.lower(own)
    slug = F.when(lowered.rlike("^[a-z][a-z0-9_-]*$"), lowered).otherwise(slugify(own))
    return F.when(own.isNull(), F.lit(fallback)).otherwise(F.coalesce(mapped(own, table or {}), slug))


def edge_id(kind: Column, source: Column, target: Column) -> Column:
    """Stable id; the ends of symmetric edges are put in order first."""
    swap = kind.isin(*SYMMETRIC) & (source > target)
    a, b = F.when(swap, target).otherwise(source), F.when(swap, source).otherwise(target)
    digest = F.substring(F.sha1(F.concat_ws("|", kind, a, b)), 1, 10)
    return F.concat_ws(":", F.lit("edge"), kind, slugify(a), slugify(b), digest)


def name_key(subject: Column, stage: Column, curriculum: Column, name: Column) -> Column:
    return F.concat_ws("|", *(slugify(F.coalesce(c, F.lit(""))) for c in (subject, stage, curriculum, name)))


def term_count(hay: Column, term: str) -> Column:
    """Occurrences of ``term`` that do not overlap."""
    return ((F.length(hay) - F.length(F.replace(hay, F.lit(term), F.lit("")))) / F.lit(len(term))).cast("bigint")


def search_score(hay: Column, query: str) -> Column:
    """Sum over the distinct places of each word of the query."""
    terms = [t.lower() for t in query.split()]

    def total(h: Column) -> Column:
        return sum((term_count(h, t) for t in terms), F.lit(0).cast("bigint"))

    # bound as the element of an array, the text is built once for all words
    return F.element_at(F.transform(F.array(hay), total), 1)


def compact(c: Column) -> Column:
    """Runs of white space as one blank."""
    return trim_u(F.regexp_replace(c, r"(?U)\s+", " "))


def compact_text(c: Column, most: int) -> Column:
    """``compact``, cut to ``most`` characters with an ellipsis."""
    own = compact(c)
    cut = F.regexp_replace(F.substring(own, 1, most - 1), r"(?U)\s+$", "")
    return F.when(F.length(own) > most, F.concat(cut, F.lit("…"))).otherwise(own)


def clean_text(c: Column) -> Column:
    """No control characters, trimmed lines, at most one blank line in a row."""
    out = F.regexp_replace(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), "\r\n?", "\n")
    lines = F.transform(F.split(out, "\n", -1), trim_u)
    return trim_u(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


def compact_spaces(c: Column) -> Column:
    """Ideographic blanks and runs of blanks as one, at most two line ends in a row."""
    out = F.regexp_replace(F.translate(c, "　", " "), r"[ \t]+", " ")
    return trim_u(F.regexp_replace(out, "\n{3,}", "\n\n"))


def paragraphs(c: Column) -> Column:
    """Blocks between blank lines, cleaned, without empty ones."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, "\r\n?", "\n"), r"\n\s*\n", -1), clean_text), lambda x: x != "")


#: What recognition often gets wrong, in the order of replacement.
OCR_FIXES = (("（", "("), ("）", ")"), ("〈", "("), ("〉", ")"), ("【教学提示了", "【教学提示】"), ("【教学提示了】", "【教学提示】"), ("FR", "年级"), ("4S", "年级"), ("王", "="), ("Bil", "例"), ("Chil", "例"), ("Cl)", "(1)"), ("CL)", "(1)"))


def ocr_fixups(c: Column) -> Column:
    out = trim_u(c)
    for old, new in OCR_FIXES:
        out = F.replace(out, F.lit(old), F.lit(new))
    return compact_spaces(out)


def is_noise(line: Column) -> Column:
    """Empty lines, page numbers, running titles, rules."""
    return (
        (F.coalesce(line, F.lit("")) == "")
        | line.rlike(r"^\p{Nd}{1,3}$")
        | (line.contains("义务教育") & line.contains("课程标准"))
        | line.startswith("四、课程内容")
        | line.isin("续表", "===")
        | line.rlike(r"(?U)^[|_=\-—\s]+$")
    )


def clean_statement(c: Column, most: int = 180) -> Column:
    """One statement: no marker, no white space, cut at a sentence end."""
    own = F.regexp_replace(compact_spaces(c), r"(?U)^\(?\s*[0-9]{1,2}\s*\)\s*", "")
    own = F.regexp_replace(F.regexp_replace(own, r"(?U)例\s*\d+", ""), r"(?U)\s+", "")
    own = F.replace(F.replace(own, F.lit("。;"), F.lit("。")), F.lit(";。"), F.lit("。"))
    head = F.substring(own, 1, most)
    out = F.concat(F.regexp_replace(head, "[，,、]+$", ""), F.lit("。"))
    for mark in reversed("。；;"):
        at = F.length(head) - F.instr(F.reverse(head), mark)
        out = F.when((F.instr(head, mark) > 0) & (at >= 60), F.substring(head, F.lit(1), at + 1)).otherwise(out)
    return F.when(F.length(own) <= most, own).otherwise(out)


def statement_name(c: Column, prefix: Column) -> Column:
    own = F.regexp_replace(c, "(?s)[。；;].*$", "")
    own = F.regexp_replace(own, "^[，,、:： ]+|[，,、:： ]+$", "")
    cut = F.regexp_replace(F.substring(own, 1, 26), "[，,、]+$", "")
    return F.concat(prefix, F.when(F.length(own) > 26, cut).otherwise(own))


def parse_grade(c: Column, fallback: int = 0) -> Column:
    """The first number in a text, else its first numeral in numeric order."""
    own = text(c)
    digits = F.regexp_extract(own, r"(\p{Nd}+)", 1)
    out = F.lit(fallback)
    for i, numeral in reversed(list(enumerate(NUMERALS, 1))):
        out = F.when(own.contains(numeral), F.lit(i)).otherwise(out)
    return F.when(own.isNull(), F.lit(fallback)).when(digits != "", F.translate(digits, "０１２３４５６７８９", "0123456789").try_cast("bigint")).otherwise(out).cast("bigint")


def confidence(c: Column) -> Column:
    return c.try_cast("double")


def in_unit(c: Column) -> Column:
    """Within [0, 1]; what is not a number is not."""
    return (c >= 0) & (c <= 1) & ~F.isnan(c)


def page_label(first: Column, last: Column) -> Column:
    label = F.when(first == last, F.concat(F.lit("PDF page "), first.cast("string"))).otherwise(F.concat(F.lit("PDF pages "), first.cast("string"), F.lit("-"), last.cast("string")))
    return F.coalesce(label, F.lit("PDF page unknown"))


def figure_number(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def ratio(count: Column, total: Column) -> Column:
    """1 where there is nothing to count."""
    return F.when(total <= 0, F.lit(1.0)).otherwise(count.cast("double") / total)


def quality_grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def round4(c: Column) -> Column:
    return F.rint(c * 10000) / 10000


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))
