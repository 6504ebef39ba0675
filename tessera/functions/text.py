"""Text, number and date expressions: Column(s) in, Column out, all inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Czech letters and their plain forms.
DIACRITICS, PLAIN = "áčďéěíňóřšťúůýž", "acdeeinorstuuyz"
WIDE_DIACRITICS, WIDE_PLAIN = "áčďéěíňóřšťúůýžäëïöüľĺŕôàè", "acdeeinorstuuyzaeioullroae"
# Words that stand for no value.
NULL_WORDS = ("none", "nan", "null", "neuvedeno", "neznámá")
EMAIL = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-.]+"
PHONE = r"\+?\d[\d\s]{7,}"


def strip_all(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def strip_diacritics(c: Column) -> Column:
    """Lower-case Czech letters without their marks."""
    return F.translate(c, DIACRITICS, PLAIN)


#: Marks that letters bear, as one letter each and as combining characters: from these come all letters whose canonical
#: decomposition is a plain letter and marks.
COMBINING = r"\p{M}+"


def _marked_letters() -> tuple[str, str]:
    """Letters of Latin, Greek and Cyrillic that decompose into a letter and marks, and what is left of them without marks."""
    import unicodedata

    pairs = [(chr(k), "".join(c for c in unicodedata.normalize("NFKD", chr(k)) if not unicodedata.combining(c))) for k in (*range(0xC0, 0x530), *range(0x1E00, 0x2000))]
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_marks(c: Column) -> Column:
    """Without the marks of any letter, precomposed or combining (canonical decomposition, marks dropped)."""
    return F.translate(F.regexp_replace(c, COMBINING, ""), *_marked_letters())


def plain_lower(c: Column) -> Column:
    return strip_diacritics(F.lower(F.trim(c)))


def norm_key(c: Column) -> Column:
    """Address key: lower case, no marks, hyphens as spaces, one space between words."""
    key = F.translate(F.lower(c), WIDE_DIACRITICS + "-", WIDE_PLAIN + " ")
    return F.trim(F.regexp_replace(key, r"\s+", " "))


def geo_key(c: Column, unknown: str = "") -> Column:
    return F.lower(F.regexp_replace(F.coalesce(blank_to_null(c), F.lit(unknown)), r"\s+", " "))


def house_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(blank_to_null(c), F.lit("")), r"\s+", ""))


def site_key(c: Column) -> Column:
    """Site id without its source prefix, one space between words."""
    bare = F.regexp_replace(F.lower(F.trim(c)), r"^(sr:|sreality:|idnes:|bez:?|avizo:)\s*", "")
    return F.regexp_replace(bare, r"\s+", " ")


def text_key(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def money(c: Column) -> Column:
    """'1 250 000,50 Kč' -> 1250000.5; text that is no number gives null."""
    bare = F.replace(F.regexp_replace(c, "Kč|CZK|[  ]", ""), F.lit(","), F.lit("."))
    return bare.try_cast("double")


def digits_price(c: Column) -> Column:
    """Only digits, points and commas are kept; a comma that is left makes null."""
    return F.nullif(F.regexp_replace(c, r"[^0-9.,]", ""), F.lit("")).try_cast("double")


def area(c: Column) -> Column:
    """'1.045,5' -> 1045.5."""
    return F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def first_integer(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit("")).try_cast("int")


def first_group(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def nth_group(c: Column, pattern: str, n: int) -> Column:
    """The n-th match's group from 0, or null."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), 1), F.lit(n))


def first_word(c: Column) -> Column:
    return F.nullif(F.lower(F.get(F.split(F.trim(c), r"\s+"), F.lit(0))), F.lit(""))


def before(c: Column, mark: str) -> Column:
    return F.substring_index(c, mark, 1)


def address_part(c: Column, n: int) -> Column:
    """The n-th part of a comma list, from 0; negative from the end of the row's own list."""
    parts = F.split(c, ",")
    return blank_to_null(F.try_element_at(parts, F.lit(n + 1 if n >= 0 else n)))


def address_part_of_widest(c: Column, n_from_end: int, widest: Column) -> Column:
    """The batch-width form: parts are counted from the end of the widest address of the batch."""
    return blank_to_null(F.get(F.split(c, ","), widest.cast("int") - n_from_end))


def disposition(c: Column) -> Column:
    """DISP_2_KK -> 2+kk."""
    return F.nullif(F.lower(F.replace(F.regexp_replace(c, "^DISP_", ""), F.lit("_"), F.lit("+"))), F.lit(""))


def phone(c: Column) -> Column:
    """Nine digits are Czech; 9 to 15 digits after a plus stay; 10 to 15 get a plus; all else is null."""
    raw = F.nullif(F.regexp_replace(F.trim(c), "[^0-9+]+", ""), F.lit(""))
    return F.when(raw.rlike("^[0-9]{9}$"), F.concat(F.lit("+420"), raw)).when(raw.rlike(r"^\+[0-9]{9,15}$"), raw).when(raw.rlike("^[0-9]{10,15}$"), F.concat(F.lit("+"), raw))


def null_words(c: Column) -> Column:
    return F.when(c.isNull() | F.lower(F.trim(c)).isin(*NULL_WORDS), "").otherwise(F.trim(c))


def contact(c: Column, most: int = 2000) -> Column:
    """struct(agent_name, agent_phone, agent_email, agency) of a seller text."""
    s = F.nullif(F.substring(c, 1, most), F.lit(""))
    email = F.nullif(F.regexp_extract(s, EMAIL, 0), F.lit(""))
    head = F.when(email.isNull(), s).otherwise(F.call_function("substring_index", s, email, F.lit(1)))
    parts = F.filter(F.transform(F.split(head, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.struct(F.get(parts, F.lit(0)).alias("agent_name"), F.nullif(F.regexp_extract(s, PHONE, 0), F.lit("")).alias("agent_phone"), email.alias("agent_email"), F.get(parts, F.lit(1)).alias("agency"))


def is_numbered_capital(key: Column) -> Column:
    """Whether an address key is that of a numbered district of the capital."""
    return F.coalesce(key.rlike(r"^praha \d+( |$)"), F.lit(False))


def capital_label(c: Column) -> Column:
    """'praha-5 Smíchov' -> 'Praha 5'; other labels are only trimmed."""
    key = norm_key(c)
    return F.when(is_numbered_capital(key), F.concat(F.lit("Praha "), F.regexp_extract(key, r"^praha (\d+)", 1))).otherwise(F.trim(c))


def url_without_query(c: Column) -> Column:
    return F.regexp_replace(c, "[?#].*$", "")


def image_extension(content_type: Column) -> Column:
    return F.when(content_type.like("%png%"), ".png").when(content_type.like("%webp%"), ".webp").otherwise(".jpg")


def to_bool(c: Column, empty: bool | None = False) -> Column:
    """Mixed truth values; what an empty string means is a parameter."""
    x = F.lower(F.trim(c.cast("string")))
    return F.when(x.isin("1", "true", "t", "yes", "y"), True).when(x.isin("0", "false", "f", "no", "n"), False).when(x == "", F.lit(empty))


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def render_prompt(template: str, values: dict[str, Column]) -> Column:
    """A template with {name} places: listed names become columns, other braces stay."""
    import re

    parts, at = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m[1] in values:
            parts += [F.lit(template[at : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit(""))]
            at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda x: x != ""))


def ymd(name: Column) -> Column:
    """The date in a snapshot table's name, <prefix>_DDMMYYYY; null if it is none."""
    return F.to_date(F.try_to_timestamp(F.right(name, F.lit(8)), F.lit("ddMMyyyy")))


def calendar(d: Column) -> list[Column]:
    """The calendar columns of a date: ISO week and weekday, Monday is 1."""
    return [F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "MMM").alias("month_name"), F.weekofyear(d).alias("week"), F.day(d).alias("day"), (F.weekday(d) + 1).alias("dow"), (F.weekday(d) >= 5).alias("is_weekend")]


def previous_month_start(ts: Column) -> Column:
    return F.add_months(F.trunc(ts, "month"), -1)
