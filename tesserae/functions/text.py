"""String functions as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column, pattern: str = TOKEN) -> Column:
    """Lower-cased words in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({pattern})"), 1)


def let(value: Column, body) -> Column:
    """``body(value)`` with value worked out once, however often the body or a lambda in it names it."""
    return F.transform(F.array(value), body)[0]


def windows_of(items: Column, size: int) -> Column:
    """Every run of ``size`` items, space-joined; none if there are fewer."""

    def runs(list_: Column) -> Column:
        count = F.size(list_) - size + 1
        starts = F.when(count > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), count))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(list_, i, size), " "))

    return let(items, runs)


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", " ")


def unescape(text: Column) -> Column:
    """The named entities of plain markup; ampersands last."""
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", " "), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return text


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def clean(html: Column, cap: int | None = None) -> Column:
    """Visible text of markup, collapsed, capped if asked; null if nothing is left."""
    body = F.regexp_replace(F.regexp_replace(html, r"(?s)<script\b.*?</script>", " "), r"(?s)<style\b.*?</style>", " ")
    said = collapse(unescape(strip_tags(body)))
    return F.nullif(said if cap is None else F.substring(said, 1, cap), F.lit(""))


def content_stream(html: Column) -> Column:
    """Lower-case letters and digits only: equal streams say the same."""
    return F.regexp_replace(F.lower(unescape(strip_tags(html))), "[^0-9a-z]+", "")


def strict_stream(html: Column) -> Column:
    """Everything but tags and white space, byte for byte."""
    return F.regexp_replace(F.regexp_replace(html, "<[^>]*>", ""), r"[ \t\r\n]+", "")


def markup_signature(html: Column) -> Column:
    """Distinct opening tags in alphabetical order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(html), F.lit("<([a-z][a-z0-9]*)"), 1)))


def slug(text: Column, cap: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, cap)


def boiler_signature(line: Column) -> Column:
    """A line's shape: digits, dashes and punctuation folded."""
    folded = F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "#"), "[–—-]+", "-")
    return F.trim(F.regexp_replace(F.regexp_replace(folded, r"[!?.,;:()\"'|*%$&]+", " "), " +", " "))


def numeric_tokens(text: Column) -> Column:
    """Numbers without thousands separators, decimals and per cents kept."""
    found = F.regexp_extract_all(text, F.lit(r"([0-9][0-9,]*(?:\.[0-9]+)?%?)"), 1)
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))


def digit_signature(number: Column) -> Column:
    """The digits in order: equal for transposed numbers."""
    return F.array_join(F.array_sort(F.split(F.regexp_replace(number, "[^0-9]", ""), "")), "")


def classes(rows: DataFrame, value: str, signature: Column, *within: str) -> DataFrame:
    """``rows`` that share a signature with others: ``(*within, value, class, n_others)``, class the least of them."""
    marked = rows.select(*within, value, signature.alias("_k"))
    found = marked.groupBy(*within, "_k").agg(F.min(value).alias("class"), (F.count("*") - 1).alias("n_others")).where("n_others > 0")
    return marked.join(found, [*within, "_k"]).select(*within, value, "class", "n_others")


def letter_signature(word: Column) -> Column:
    return F.array_join(F.array_sort(F.split(word, "")), "")


def clause_refs(text: Column) -> Column:
    """Clause keys such as ``A2.1(b)``, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b([A-Z][0-9]+(?:\.[0-9]+)*(?:\([a-z]\))?)"), 1)))


def parent_key(key: Column) -> Column:
    """One level up: a trailing group in brackets, else the last dotted part; null at the top."""
    up = F.when(key.endswith(")"), F.regexp_replace(key, r"\([^()]*\)$", "")).otherwise(F.regexp_replace(key, r"\.[^.]*$", ""))
    return F.when(up != key, up)


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("bigint")


def plausible_title(text: Column) -> Column:
    """Short, begins with a capital or digit, doesn't end like a sentence."""
    return F.length(text).between(3, 120) & text.rlike("^[A-Z0-9]") & ~text.rlike(r"[.;,]$")


def numbering_level(text: Column) -> Column:
    """Depth of a leading number such as ``2.1``; null without one, with end punctuation or before a small letter."""
    mark = F.regexp_extract(text, r"^([0-9]+(?:\.[0-9]+)*)\.? +[A-Z0-9]", 1)
    return F.when((mark != "") & ~text.rlike(r"[.;,]$"), F.size(F.split(mark, r"\.")))


def marker_family(text: Column) -> Column:
    """Kind of list marker that a line starts with."""
    return (
        F.when(text.rlike(r"^[0-9]+(\.[0-9]+)*[.)]? "), "decimal").when(text.rlike(r"^\((i|ii|iii|iv|v|vi|vii|viii|ix|x)\) "), "roman")
        .when(text.rlike(r"^\([a-z]\) "), "alpha").when(text.rlike(r"^(Part|Schedule|Annex|Appendix) [A-Z0-9]+\b"), "part").when(text.rlike(r"^[•*-] "), "bullet")
    )


def text_windows(text: Column, size: int, overlap: int, most: int | None = None) -> Column:
    """Overlapping windows by characters, at most ``most`` if given."""
    step = size - overlap
    count = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / F.lit(step)))
    count = (count if most is None else F.least(F.lit(most), count)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(text, i * step + 1, size))


def edge_prefixes(word: Column, least: int = 2, most: int = 15) -> Column:
    return F.transform(F.sequence(F.lit(least), F.greatest(F.lit(least), F.least(F.lit(most), F.length(word)))), lambda n: F.substring(word, 1, n))


def heading_mark(title: Column) -> Column:
    """Family of the number that a heading starts with: decimal, upper_alpha, paren_roman or paren_alpha.

    A lone number needs its dot (dates and addresses begin with one), and a
    trailing number makes the line an entry of a table of contents.
    """
    found = (
        F.when(title.rlike(r"^([0-9]+(\.[0-9]+)+\.?|[0-9]+\.)\s+\S"), "decimal").when(title.rlike(r"^[A-Z]\.\s+\S"), "upper_alpha")
        .when(title.rlike(r"^\([ivxlcdmIVXLCDM]{2,}\)\s*\S"), "paren_roman").when(title.rlike(r"^\([a-zA-Z]+\)\s*\S"), "paren_alpha")
    )
    return F.when(~title.rlike(" [0-9]{1,4}$"), found)


def mark_depth(title: Column) -> Column:
    """How deep a heading's number says that it is: its dotted parts, one for letters."""
    mark = heading_mark(title)
    return F.when(mark == "decimal", F.size(F.split(F.rtrim(F.regexp_extract(title, "^([0-9.]+)", 1), F.lit(".")), r"\."))).when(mark.isNotNull(), 1)


def clean_markdown(line: Column) -> Column:
    """A line without the marks of headings, notes, tags and tables."""
    bare = F.regexp_replace(F.regexp_replace(line, "^#{1,6} +", ""), r"\[\^[0-9]+\]:?", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), r"\|", " "), "[ \t]+", " "))


def linkify(text: Column) -> Column:
    """Bare urls as markdown links, trailing punctuation left out."""
    return F.regexp_replace(text, r"(^|[\s])(\(?)(https?://[^\s<>()\[\]\"]*[^\s<>()\[\]\".,;:!?])", "$1$2[$3]($3)")


def normal_key(key: Column) -> Column:
    """A clause key with brackets as dots: ``H1.6(a)`` is ``H1.6.a``."""
    return F.trim(F.replace(F.replace(key, F.lit("("), F.lit(".")), F.lit(")"), F.lit("")), F.lit("."))


def cited(citation: Column) -> Column:
    """Place and clause keys of a citation such as ``Name Survey A3.1, B2 and C1``; null without any."""
    pattern = r"(?i)^(.+?)\s+survey\s+(.*)$"
    keys = F.transform(F.split(F.regexp_extract(citation, pattern, 2), "[,;]| and "), lambda x: F.rtrim(F.regexp_extract(F.trim(x), r"^([A-K][0-9][A-Za-z0-9_.()]*)", 1), F.lit(".")))
    place = F.regexp_extract(citation, pattern, 1)
    return F.when(place != "", F.struct(place.alias("place"), F.filter(keys, lambda x: x != "").alias("keys")))


def path_key(path: Column) -> Column:
    """The clause key of a file in a tree of parts: ``A-part/2.1-rules/2.1.2-more.md`` is ``A2.1.2``."""
    part, name = F.substring(path, 1, 1), F.regexp_extract(path, "/([^/]*)$", 1)
    above = F.coalesce(F.nullif(F.regexp_extract(path, r"^[^/]*/([0-9]+(?:\.[0-9]+)+)-[^/]*/", 1), F.lit("")), F.regexp_extract(path, r"^[^/]*/0*([0-9]+)-[^/]*/", 1))
    return (
        F.when(name.rlike("^(README|glossary)"), None).when(name.rlike(r"^[0-9]+(\.[0-9]+)+-"), F.concat(part, F.regexp_extract(name, r"^([0-9]+(?:\.[0-9]+)+)-", 1)))
        .when(name.rlike(r"^\(?[a-z]{1,4}\)?[-.]") & (above != ""), F.concat(part, above, F.lit("("), F.regexp_extract(name, r"^\(?([a-z]{1,4})\)?[-.]", 1), F.lit(")")))
        .when(name.startswith("00-"), F.concat(part, above)).when(name.rlike("^0*[0-9]+-"), F.concat(part, F.regexp_extract(name, "^0*([0-9]+)-", 1)))
    )


def like_contents(words: Column) -> Column:
    """Do words read like a table of contents? At least eight, numbers among them, short ones mostly rising."""

    def shape(w: Column) -> Column:
        digits = F.filter(w, lambda x: x.rlike("^[0-9]+$"))
        pages = F.transform(F.filter(digits, lambda x: F.length(x) <= 4), lambda x: x.cast("int"))
        pairs = F.arrays_zip(F.slice(pages, 1, F.greatest(F.lit(0), F.size(pages) - 1)).alias("a"), F.slice(pages, 2, F.greatest(F.lit(0), F.size(pages) - 1)).alias("b"))
        rising = F.size(F.filter(pairs, lambda p: p["b"] >= p["a"])) / F.greatest(F.lit(1), F.size(pages) - 1)
        return (F.size(w) >= 8) & (F.size(digits) / F.greatest(F.lit(1), F.size(w)) >= 0.15) & (F.size(pages) >= 2) & (rising >= 0.4)

    return let(words, shape)


#: What a heading's first and last characters don't look like, and the words it has fewer of. Fixed values.
PROSE_START, PROSE_END, HEADING_WORDS = r"^(?:\(?[0-9a-z]{1,4}\)\s+)?[a-z]", r"[,;:]$|^(?![0-9.]+$).*\.$", 10


def heading_like(title: Column) -> Column:
    """Does an entry read as a heading? It has a word, fewer than ten, and neither starts nor ends as prose does.

    Prose starts with a small letter, after a bracketed number or without one,
    and ends with a comma, a colon, a semicolon or, unless all is digits and
    stops, a stop.
    """
    said = F.trim(title)
    return (F.size(F.filter(F.split(said, r"\s+"), lambda w: w != "")).between(1, HEADING_WORDS - 1)) & ~said.rlike(f"{PROSE_START}|{PROSE_END}")
