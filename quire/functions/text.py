"""Text rules as Column expressions: built-in functions only, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
QUALIFIERS = "annotated|revised|reissue|updated|expanded|enlarged|new|first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth"
ADVERBS = "fully|completely|newly|partially|extensively"
OFF_WORDS = "er|ers|ered|ering|erings|ice|ices|icer|icers|icial|ials|ially|set|sets|line|end|ends|ended|ender|enders|ending|ense|enses|ensive|spring|beat|hand|load|shore|side|stage|season|shoot|shoots|ish|putting|ramp|screen|site|track|year"
STUFF_WORDS = "ed|ing|ings|s|y|ier|iest"
SELF_WORDS = "ish|ishly|ishness|less|lessness|lessly|same|dom|hood"
ROMAN = "(?i)^(?=.)m{0,4}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"
MARKDOWN = r"(?ms)<!--.*?-->|[#*_`|]+|^-{3,}$"
ARTIFACTS = (r"(?i)[a-z]\d[a-z]", r"(?i)[a-z]vv[a-z]")
OCR_PATTERNS = (r"\b[B-DF-HJ-NP-TV-Z]{4,}\b", r"\bIne\.\b", r"(?i)[a-z]\d[a-z]")
CAPTION = r"(?m)^\s*\**\s*(TABLE|Table|TAB\.|Tab\.|EXHIBIT|Exhibit)\s+[A-Z]?-?\d+([-.]\d+)?"
SEPARATOR = r"(?m)^\s*\|(\s*:?-+:?\s*\|)+\s*$"
STRUCTURAL = r"^$|^<!-- Page|^#|^>|^- |^\* |^\||^\d+[.)]\s|^```|^---|^\*\*\*|^[A-Z][A-Z\s]{5,}$"
STRAY = r"\b[b-df-hj-np-tv-z]([A-Z][a-z]{2,})\b"
CAPS_WORDS = (
    "a an the and or but of in on at by for to from with without into onto over under up down out off as is are was were be been being am i you we us our "
    "your their his her its this that these those if then than so not no yes all any some each every other another such which who what when where why how "
    "also annotated revised updated expanded enlarged edition introduction foreword preface acknowledgments contents chapter part section appendix index "
    "bibliography copyright published volume series reissue first second third fourth fifth complete abridged unabridged illustrated author authors editor "
    "editors translated translator publisher human side enterprise management leadership organization organizations organizational behavior science "
    "business history culture economy economics theory practice principles method methods system systems model models analysis study research guide "
    "handbook overview fundamentals essentials foundations thinking decision making strategy strategic tactical innovation design development growth change "
    "transition work workplace team teams group groups people person leader leaders manager managers founder founders company companies corporation project "
    "process product quality productivity performance operations crisis modern contemporary global local drive motivate motivation inspire inspiration "
    "purpose new old mcgregor deming pink daniel douglas edwards"
).split()
MIN_CHARS, LOW_QUALITY, WARNING_DENSITY, LOW_TEXT = 500, 0.5, 2.0, 0.1


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once for each row: unlike withColumn, later conditions on them do not put their expressions in place of their names."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of value, which is computed once however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def is_roman(text: Column) -> Column:
    return text.rlike(ROMAN)


def is_arabic(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def is_structural(stripped: Column) -> Column:
    return stripped.rlike(STRUCTURAL)


def plain(text: Column) -> Column:
    """Text with each run of Markdown syntax replaced by a space."""
    return F.regexp_replace(text, MARKDOWN, " ")


def artifact_counts(text: Column) -> Column:
    """(chars, artifacts) of plain text; sums over the parts of a text, cut where no mark and no word is, are those of the whole."""
    return let(plain(text), lambda body: F.struct(F.length(body).cast("long").alias("chars"), (count(body, ARTIFACTS[0]) + count(body, ARTIFACTS[1])).cast("long").alias("artifacts")))


def score_of(counts: Column) -> Column:
    """The quality score of a text with these artifact_counts."""
    return F.when(counts.chars < MIN_CHARS, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - counts.artifacts * 10000.0 / counts.chars / 2))


def quality_score(text: Column) -> Column:
    """1 for clean text, falling with the density of extraction artifacts; short texts score 1."""
    return let(artifact_counts(text), score_of)


def misread_counts(text: Column) -> Column:
    """(chars, then the matches of each of OCR_PATTERNS) of plain text, which add up like artifact_counts."""
    return let(plain(text), lambda body: F.struct(F.length(body).cast("long").alias("chars"), *(count(body, p).cast("long").alias(f"p{k}") for k, p in enumerate(OCR_PATTERNS))))


def dense(counts: Column) -> list[Column]:
    """Of misread_counts those that reach the warning level, else null."""
    return [F.when((counts.chars >= MIN_CHARS) & (counts[f"p{k}"] * 10000.0 / counts.chars >= WARNING_DENSITY), counts[f"p{k}"]) for k in range(len(OCR_PATTERNS))]


def ocr_warning_counts(text: Column) -> list[Column]:
    """Matches of each pattern where their density reaches the warning level, else null."""
    body = plain(text)
    n = F.length(body)
    return [F.when((n >= MIN_CHARS) & (count(body, p) * 10000.0 / n >= WARNING_DENSITY), count(body, p)) for p in OCR_PATTERNS]


def table_signals(text: Column) -> tuple[Column, Column]:
    """Tables emitted, table captions seen."""
    return count(text, SEPARATOR) + count(text, r"(?i)<table"), count(text, CAPTION)


def rebuild(text: Column, pattern: str, replacement: Callable[[Column], Column]) -> Column:
    """Text with each match replaced by a Column of the match: unlike regexp_replace, each match has a decision of its own."""
    between, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.array_join(F.zip_with(between, matches, lambda a, m: F.concat(a, F.coalesce(replacement(m), F.lit("")))), "")


def per_line(text: Column, f: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.split(text, "\n"), f), "\n")


def ligatures(text: Column) -> Column:
    for a, b in (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬁ", "fi"), ("ﬀ", "ff"), ("ﬂ", "fl")):
        text = F.replace(text, F.lit(a), F.lit(b))
    text = F.regexp_replace(text, r"(?U)(\w*(?:fi|ff|fl))\s+([a-z]{1,8})\b", "$1$2")
    text = F.regexp_replace(F.regexp_replace(text, r"(?U)\bTh\s+e\b", "The"), r"(?U)\bth\s+e\b", "the")
    return F.regexp_replace(text, "(?U)\u00ad\\s+", "")


def spaced_letters(text: Column) -> Column:
    """Runs of at least four single letters with white space between lose their plain spaces."""
    return rebuild(text, r"(?U)\b[A-Za-z](?:\s{1,3}[A-Za-z]){3,}\b", lambda m: F.replace(m, F.lit(" "), F.lit("")))


def segmented(word: Column) -> Column:
    """A word cut into the fewest words of CAPS_WORDS, null where there is no such cut; of equals the one whose last word is longest.

    The state holds the best cut of every beginning of the word.
    """
    known = F.array(*map(F.lit, CAPS_WORDS))
    none = "struct<n:int,at:int,words:string>"

    def step(best: Column, i: Column) -> Column:
        def ending(j: Column) -> Column:
            part, before = F.substring(word, j + 1, i - j), F.get(best, j)
            fits = before.n.isNotNull() & F.array_contains(known, F.lower(part))
            return F.when(fits, F.struct((before.n + 1).alias("n"), j.alias("at"), F.when(j == 0, part).otherwise(F.concat(before.words, F.lit(" "), part)).alias("words")))

        ways = F.array_compact(F.transform(F.sequence(F.greatest(F.lit(0), i - 15), i - 1), ending))
        return F.concat(best, F.array(F.array_min(ways).cast(none)))

    zero = F.array(F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit("").alias("words")).cast(none))
    best = F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(word)), zero, step), -1)
    singles = F.size(F.filter(F.split(best.words, " "), lambda x: F.length(x) == 1))
    return F.when((best.n >= 2) & (singles <= 1), best.words)


def joined_caps(text: Column) -> Column:
    """Long runs of capitals on short lines of mostly capitals are cut into known words."""

    def line(x: Column) -> Column:
        s = strip(x)
        letters, upper = F.length(F.regexp_replace(s, r"\P{L}", "")), F.length(F.regexp_replace(s, r"\P{Lu}", ""))
        heading = (F.length(s) <= 80) & (letters > 0) & (upper >= 0.8 * letters) & s.rlike(r"\b[A-Z]{6,}\b")
        return F.when(heading, rebuild(x, r"(?U)\b[A-Z]{6,}\b", lambda w: F.coalesce(segmented(w), w))).otherwise(x)

    return per_line(text, line)


def contents_lines(text: Column) -> Column:
    """A long line of three or more titles with page numbers becomes one item a title."""
    title, number = r"[A-Z][A-Za-z\s':,\-]+?", r"[ivxlc]+|\d{1,3}"

    def line(x: Column) -> Column:
        s = strip(x)
        entry = rf"({title})\s+({number})(?=\s+[A-Z]|\s*\z)"
        items = F.zip_with(F.regexp_extract_all(s, F.lit(entry), 1), F.regexp_extract_all(s, F.lit(entry), 2), lambda t, n: F.concat(F.lit("- "), strip(t), F.lit(" ... "), n))
        many = (F.length(s) > 60) & (count(s, rf"{title}\s+(?:{number})") >= 3) & (F.size(items) >= 3)
        return F.when(many, F.array_join(items, "\n")).otherwise(x)

    return per_line(text, line)


def missing_spaces(text: Column) -> Column:
    for stem, words, to in (("off", OFF_WORDS, "off "), ("stuff", STUFF_WORDS, "stuff "), ("self", SELF_WORDS, "self-")):
        text = F.regexp_replace(text, rf"\b{stem}(?!(?i:{words})(?![a-z]))(?=[a-z])", to)
    return text


def title_marks() -> str:
    """What a title's end may bear, as one repeated pattern: the longest run of marks goes at once."""
    chain = rf"(?:{QUALIFIERS})(?:\s*(?:,|and|&)\s*(?:(?:{ADVERBS})\s+)?(?:{QUALIFIERS}))*"
    marks = (
        r"\s*[Vv]\d+(?:\.\d+)?\s*",
        r"\s*\d+(?:st|nd|rd|th)\s+[Ee]dition\s*",
        r"(?i:\s*\d+(?:st|nd|rd|th)\s+Anniversary\s+[Ee]dition\s*)",
        rf"(?i:\s*(?:(?:{ADVERBS})\s+)?{chain}(?:\s+[Ee]dition)?\s*)",
        r"\s*\([^)]*[Ee]dition[^)]*\)\s*",
        r"[,;:\-\s]+",
    )
    return f"(?:{'|'.join(marks)})+$"


def clean_title(stem: Column) -> Column:
    """A title without edition and version marks at its end, however many there are."""
    return strip(F.regexp_replace(stem, title_marks(), ""))


def bullets(text: Column) -> Column:
    """Lines with two or more bullets and two or more items become one item a line; a bullet at a line's start becomes a dash."""
    marks = "[●•◆▪▸►‣⬥]"
    items = lambda line: F.filter(F.transform(F.split(line, marks), strip), lambda x: x != "")
    dashed = lambda line: F.array_join(F.transform(items(line), lambda x: F.concat(F.lit("- "), x)), "\n")
    text = per_line(text, lambda line: F.when((F.regexp_count(line, F.lit(marks)) >= 2) & (F.size(items(line)) >= 2), dashed(line)).otherwise(line))
    return F.regexp_replace(text, rf"(?md)^(\s*){marks}\s*", "$1- ")


def stray_consonants(text: Column) -> tuple[Column, Column]:
    return F.regexp_replace(text, STRAY, "$1"), count(text, STRAY)


def without_frontmatter(body: Column) -> Column:
    return F.regexp_replace(body, r"(?s)\A---\n.*?\n---\n\s*", "")


def without_noise(body: Column) -> Column:
    body = F.regexp_replace(F.regexp_replace(body, r"(?s)<!--.*?-->", ""), r"(?m)^[ \t]*!\[\]\([^)]*\)[ \t]*$", "")
    return F.concat(strip(F.regexp_replace(body, r"\n{3,}", "\n\n")), F.lit("\n"))


def is_local(target: Column) -> Column:
    return (target != "") & ~target.rlike("^(//|#)") & ~target.rlike("^[A-Za-z][A-Za-z0-9+.-]+:")


def link_target(inner: Column) -> Column:
    inner = strip(inner)
    return F.when(inner.rlike("^<[^>]*>"), F.regexp_extract(inner, "^<([^>]*)>", 1)).otherwise(strip(F.regexp_replace(inner, r"\s+(\"[^\"]*\"|'[^']*')$", "")))


def heading_html(level: Column, label: Column) -> Column:
    tag = F.concat(F.lit("h"), F.greatest(F.lit(1), F.least(F.lit(6), level)).cast("string"))
    safe = F.replace(F.replace(F.replace(label, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<"), tag, F.lit(">"), safe, F.lit("</"), tag, F.lit(">"))


def safe_stem(stem: Column) -> Column:
    return F.regexp_replace(stem, r"\s+", "_")


def looks_like_list(text: Column) -> Column:
    """Index and list pages: many short lines, most in alphabetical order or very short."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: (x != "") & ~x.startswith("<!-- "))
    n = F.size(lines)
    short = F.size(F.filter(lines, lambda x: (F.length(x) < 80) & ~x.rlike("[.!?:;]$")))
    mean = F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(x)) / F.when(n > 0, n)
    leaders = F.array(*map(F.lit, "and as at by for from in into of on or the to with vs see".split()))
    top = F.filter(lines, lambda x: x.rlike(r"(?U)^\p{Alpha}") & ~x.rlike(r"(?U)^\p{Lower}") & ~F.array_contains(leaders, F.lower(F.regexp_extract(x, "^([A-Za-z]*)", 1))))
    initials = F.transform(top, lambda x: F.lower(F.substring(x, 1, 1)))
    pairs = F.size(initials) - 1
    ordered = F.size(F.filter(F.zip_with(F.slice(initials, 1, F.greatest(pairs, F.lit(0))), F.slice(initials, 2, F.greatest(pairs, F.lit(1))), lambda a, b: a <= b), lambda x: x))
    shape = (n >= 10) & (short >= 0.8 * n) & (mean < 50)
    return F.coalesce(shape & (((F.size(initials) >= 8) & (ordered >= 0.75 * pairs)) | (mean < 25)), F.lit(False))


FENCES = ("", "```", "~~~")


def heading_steps(text: Column) -> Column:
    """For each of FENCES, as the one that is open before text: (fence, n), the one that is open behind it and the ATX headings outside code fences.

    A fence closes with the kind that opened it.
    """
    step = lambda a, line: F.when(
        a.fence != "", F.struct(F.when(strip(line).startswith(a.fence), "").otherwise(a.fence).alias("fence"), a.n.alias("n"))
    ).when(strip(line).startswith("```"), F.struct(F.lit("```").alias("fence"), a.n.alias("n"))).when(strip(line).startswith("~~~"), F.struct(F.lit("~~~").alias("fence"), a.n.alias("n"))).otherwise(F.struct(F.lit("").alias("fence"), (a.n + F.when(line.rlike(r"^#{1,6}\s+\S"), 1).otherwise(0)).alias("n")))
    lines = F.split(text, "\r\n|[\n\r]")
    return F.array(*(F.aggregate(lines, F.struct(F.lit(f).alias("fence"), F.lit(0).alias("n")), step) for f in FENCES))


def heading_count(text: Column) -> Column:
    """ATX headings outside code fences."""
    return F.get(heading_steps(text), F.lit(0)).n


def steps_together(steps: Column) -> Column:
    """heading_steps of the whole of an array of those of its parts in order."""
    zero = F.array(*(F.struct(F.lit(f).alias("fence"), F.lit(0).alias("n")) for f in FENCES))

    def then(so_far: Column, one: Column) -> Column:
        behind = lambda a: F.get(one, F.array_position(F.lit(list(FENCES)), a.fence).cast("int") - 1)
        return F.transform(so_far, lambda a: F.struct(behind(a).fence.alias("fence"), (a.n + behind(a).n).alias("n")))

    return F.aggregate(steps, zero, then)


#: A line feed before a line that stands by itself: blank, a mark, a heading, a quotation, an item, a row, a fence, or capitals.
BLOCK = (
    r"\n(?=[^\S\n]*(?:\n|\z|<!-- Page|#|>|[-*] [^\S\n]*[^\s]|\||\d+[.)][^\S\n]+\S|```|---|\*\*\*"
    r"|[A-Z](?:[A-Z]|[^\S\n]){4,}[A-Z][^\S\n]*(?:\n|\z)))"
)
FRONT = r"(?s)\A[^\S\n]*---[^\S\n]*(?:\n.*?)??\n[^\S\n]*---[^\S\n]*(?:\n|\z)"


def fold_paragraphs(text: Column) -> Column:
    """Wrapped lines joined to paragraphs; front matter between --- lines stays as it is.

    The text is first cut before lines that stand by themselves, so that only
    the lines of one block are joined one after another. In a block a line
    stays apart if what is joined so far ends a sentence, is longer than 40
    characters and a capital follows. Null stays null.
    """

    def step(a, line):
        s, so_far = strip(line), F.regexp_replace(a.cur, r"(?U)\s+\z", "")
        ends = so_far.rlike("[.!?\"”]$") & s.rlike(r"(?U)^\p{Lu}") & (F.length(so_far) > 40)
        joined = F.when(so_far.endswith("-") & s.rlike(r"(?U)^\p{Ll}"), F.concat(F.regexp_replace(so_far, "-$", ""), s)).otherwise(F.concat(so_far, F.lit(" "), s))
        return F.struct(F.when(ends, F.array_append(a.done, a.cur)).otherwise(a.done).alias("done"), F.when(ends, line).otherwise(joined).alias("cur"))

    def folded(lines: Column) -> Column:
        zero = F.struct(F.array().cast("array<string>").alias("done"), F.get(lines, F.lit(0)).alias("cur"))
        return F.aggregate(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), zero, step, lambda a: F.array_join(F.array_append(a.done, a.cur), "\n"))

    def block(x: Column) -> Column:
        lines = F.split(x, "\n", -1)
        first = F.get(lines, F.lit(0))
        alone = is_structural(strip(first)) & ~first.rlike(r"^\s*(?:[-*]\s|\d+[.)]\s)")
        rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
        return F.when(~alone, F.when(F.size(lines) == 1, x).otherwise(folded(lines))).when(F.size(lines) == 1, x).otherwise(F.concat(first, F.lit("\n"), folded(rest)))

    opens = text.rlike(r"\A[^\S\n]*---[^\S\n]*(?:\n|\z)")
    front = F.when(opens, F.when(text.rlike(FRONT), F.regexp_extract(text, FRONT, 0)).otherwise(text)).otherwise("")
    body = F.substring(text, F.length(front) + 1, F.length(text))
    done = F.array_join(F.transform(F.split(body, BLOCK, -1), block), "\n")
    return F.when(opens & (body == ""), text).otherwise(F.concat(front, done))


def clean_text(text: Column, preserve_newlines: bool | Column = False) -> Column:
    """All text rules in their order; where newlines are preserved (pages that are lists) lines are not joined."""
    for rule in (ligatures, missing_spaces, spaced_letters, joined_caps, bullets):
        text = let(text, rule)  # a rule names its text several times, which would double the work of all before it
    keep = preserve_newlines if isinstance(preserve_newlines, Column) else F.lit(preserve_newlines)
    return let(text, lambda t: F.when(keep, t).otherwise(fold_paragraphs(t)))
