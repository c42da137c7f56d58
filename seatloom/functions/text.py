"""Column expressions over the domain's texts: bidding windows, terms, course codes, names, lists. No Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Round and window forms, in the order in which they are tried; the letter is added to the round.
WINDOW_FORMS = (
    (r"(?i)Incoming\s+Freshmen\s+Rnd\s+(\w+)\s+Win\s+(\d+)", "F"),
    (r"(?i)Incoming\s+Exchange\s+Rnd\s+(\w+)\s+Win\s+(\d+)", ""),
    (r"(?i)Round\s+(\d[A-C]?|\d+F?)\s+Window\s+(\d+)", ""),
)
ABBREVIATED = (r"(?i)Rnd\s+(\d[A-C]?|\d+F?)\s+Win\s+(\d+)", "")
ROUND_ORDER = {"1": 1, "1A": 2, "1B": 3, "1C": 4, "1F": 5, "2": 6, "2A": 7, "2F": 8}


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression's group; null where it doesn't match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once a row, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_window(text: Column, abbreviated: bool = True, generic: bool = False) -> Column:
    """Bidding-window text -> struct<round string, window int>; null where no form fits."""
    forms = [*WINDOW_FORMS, *([ABBREVIATED] if abbreviated else [])]
    out = None
    for pattern, letter in forms:
        this = F.struct(F.concat(F.regexp_extract(text, pattern, 1), F.lit(letter)).alias("round"), F.regexp_extract(text, pattern, 2).try_cast("int").alias("window"))
        out = F.when(text.rlike(pattern), this) if out is None else out.when(text.rlike(pattern), this)
    if generic:
        loose = r"(\d[A-C]?|\d+F?)"
        window = F.coalesce(found(text, r"Window\s+(\d+)|Win\s+(\d+)", 1), found(text, r"Window\s+(\d+)|Win\s+(\d+)", 2), F.lit("1"))
        out = out.when(text.rlike(loose), F.struct(F.regexp_extract(text, loose, 1).alias("round"), window.try_cast("int").alias("window")))
    return out


def abbreviation(window: Column) -> Column:
    """R<round>W<window> of a parsed window."""
    return F.concat(F.lit("R"), window["round"], F.lit("W"), window["window"].cast("string"))


def round_ordinal(round_: Column) -> Column:
    """Place of a round; 99 for others."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ROUND_ORDER.items() for x in kv]), round_), F.lit(99))


def split_course(code: Column) -> Column:
    """Course code -> struct<subject string, number int>; a code of another form keeps its text with number 0."""
    c = F.upper(F.trim(code))
    form = r"^([A-Z\-]+)(\d+)"
    fits = c.rlike(form)
    return F.struct(F.when(fits, F.regexp_extract(c, form, 1)).otherwise(c).alias("subject"), F.when(fits, F.regexp_extract(c, form, 2).try_cast("int")).otherwise(0).alias("number"))


def term_id(year: Column, term: Column) -> Column:
    """AY202526T1 from a start year and a term without its T."""
    return F.concat(F.lit("AY"), year.cast("string"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"), F.lit("T"), term)


def term_display(term: Column) -> Column:
    """AY202526T3A -> 2025-26 Term 3A."""
    return F.concat(F.substring(term, 3, 4), F.lit("-"), F.substring(term, 7, 2), F.lit(" Term "), F.substring(term, 10, 9))


def term_dashed(term: Column) -> Column:
    """AY202526T3A -> 2025-26_T3A."""
    return F.concat(F.substring(term, 3, 4), F.lit("-"), F.substring(term, 7, 2), F.lit("_T"), F.substring(term, 10, 9))


def term_from_text(text: Column) -> Column:
    """Display or dashed form -> id; null for others."""
    form = r"^(\d{4})-(\d{2})(?: Term |_T)(\w+)$"
    return F.when(text.rlike(form), F.regexp_replace(text, form, "AY$1$2T$3"))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def aliases(text: Column) -> Column:
    """Alias list from JSON text, brace text with quotes, or a single name; null gives an empty list."""
    t = F.trim(text)
    braces = F.transform(F.regexp_extract_all(t, F.lit(r'("[^"]*"|[^,{}"]+)'), 1), lambda x: F.trim(F.regexp_replace(x, '^"|"$', "")))
    nothing = F.array().cast("array<string>")
    return (
        F.when(t.isNull() | (t == ""), nothing)
        .when(t.startswith("["), F.coalesce(F.from_json(t, "array<string>"), nothing))
        .when(t.startswith("{"), F.filter(braces, lambda x: x != ""))
        .otherwise(F.array(t))
    )


def listed(text: Column) -> Column:
    """Comma list -> trimmed parts, blanks dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def name_variations(name: Column) -> Column:
    """Upper-case forms of a name under which it can be known, most literal first."""
    n = F.upper(F.trim(name))
    bare = F.replace(n, F.lit(","), F.lit(""))
    parts = F.split(F.regexp_replace(bare, r"\s+", " "), " ")
    rest = lambda i: F.array_join(F.slice(parts, i, 1 << 20), " ")
    spaced = F.trim(F.regexp_replace(F.replace(n, F.lit(","), F.lit(" ")), r"\s+", " "))
    forms = F.array(n, bare, spaced, F.regexp_replace(bare, r"\s", ""), F.concat(parts[0], F.lit(", "), rest(2)), F.concat(parts[0], F.lit(" "), F.get(parts, F.lit(1)), F.lit(", "), rest(3)))
    # names with a comma have no comma put in
    number = F.when(n.contains(","), 4).otherwise(F.least(F.size(parts) + 3, F.lit(6)))
    return F.slice(forms, F.lit(1), F.when(F.size(parts) < 2, 4).otherwise(number))


def is_unset(text: Column) -> Column:
    """Text that stands for a missing name."""
    return text.isNull() | F.lower(F.trim(text)).isin("nan", "tba", "to be announced", "")


def date_text(text: Column) -> Column:
    """d-Mon-yyyy -> yyyy-MM-dd 00:00:00.000 +0800; null where it isn't a date."""
    return F.date_format(F.try_to_timestamp(text, F.lit("d-MMM-yyyy")), "yyyy-MM-dd 00:00:00.000 '+0800'")


def whole_number(text: Column) -> Column:
    """Digits only, else null."""
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("int"))


def percent_change(now: Column, before: Column) -> Column:
    """Change in percent; 0 without a positive base."""
    return F.when(before > 0, (now - before) / before * 100).otherwise(F.lit(0.0))


def entropy_confidence(p: Column) -> Column:
    """1 - H(p) / ln(k) of an array of probabilities."""
    return 1 - F.aggregate(p, F.lit(0.0), lambda a, x: a - x * F.log(x + 1e-10)) / F.log(F.size(p).cast("double"))


# Byte pairs of UTF-8 that were read as another encoding, and what they stand for, in the order of repair.
ENCODING_REPAIRS = (
    ('â€"', "—"), ("â€™", "'"), ("â€¦", "…"), ("â€¢", "•"), ("â€‹", ""), ("â€‚", " "), ("â€ƒ", " "), ("â€‰", " "), ("â€", '"'), ("Â", ""),
)


def repair_encoding(text: Column) -> Column:
    """Mis-decoded characters repaired, trimmed; accented letters stay."""
    for bad, good in ENCODING_REPAIRS:
        text = F.replace(text, F.lit(bad), F.lit(good))
    return F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))


# Forms of a class header, in the order in which they are tried; the last column tells whether two groups make the code.
HEADER_FORMS = (
    (r"^([A-Z0-9_-]+)\s+—\s+(.+)", False), (r"^([A-Z0-9_-]+)\s+-\s+(.+)", False), (r"^([A-Z]+)\s+(\d+[A-Z0-9_]*)\s+—\s+(.+)", True),
    (r"^([A-Z]+)\s+(\d+[A-Z0-9_]*)\s+-\s+(.+)", True), (r"^([A-Z0-9_\s-]+?)\s+—\s+([^—]+)", False), (r"^([A-Z0-9_\s-]+?)\s+-\s+([^-]+)", False),
)
SECTION = r"(SG\d+|G\d+|\d+)"


def parse_header(text: Column) -> Column:
    """Class header -> struct<course_code string, section string>; null where no form fits."""
    t = F.trim(F.regexp_replace(F.regexp_replace(repair_encoding(text), r"<[^>]+>", ""), r"\s+", " "))
    inner = rf"^(.+?)\s+{SECTION}$"
    out = None
    for form, split in HEADER_FORMS:
        if split:
            code, section = F.concat(F.regexp_extract(t, form, 1), F.regexp_extract(t, form, 2)), found(F.regexp_extract(t, form, 3), SECTION)
        else:
            head = F.trim(F.regexp_extract(t, form, 1))
            has = head.rlike(inner)
            code = F.when(has, F.regexp_extract(head, inner, 1)).otherwise(head)
            section = F.when(has, F.regexp_extract(head, inner, 2)).otherwise(found(F.regexp_extract(t, form, 2), SECTION))
        this = F.struct(F.trim(code).alias("course_code"), section.alias("section"))
        out = F.when(t.rlike(form), this) if out is None else out.when(t.rlike(form), this)
    return out


def term_code(description: Column) -> Column:
    """Term of a free text; ``T3`` where it doesn't tell 3A from 3B."""
    d = F.lower(description)
    holds = lambda *words: F.greatest(*[d.contains(w) for w in words]) if len(words) > 1 else d.contains(words[0])
    return (
        F.when(holds("term 1", "session 1", "august term"), "T1").when(holds("term 2", "session 2", "january term"), "T2")
        .when(holds("term 3a"), "T3A").when(holds("term 3b"), "T3B").when(holds("term 3"), "T3")
    )


def parse_term(text: Column, folder: Column) -> Column:
    """Term text and folder name -> struct<year_start int, year_end int, term string, acad_term_id string>; null without years.

    The folder tells the term where the text doesn't, and 3A from 3B.
    """
    form = r"(\d{4})-(\d{2})\s+(.*)"

    def read(t: Column) -> Column:
        parts = F.struct(*[F.regexp_extract(t, form, i + 1).alias(n) for i, n in enumerate(("start", "end", "rest"))])
        return F.when(t.rlike(form), once(parts, told))

    def told(p: Column) -> Column:
        by_folder = F.concat(F.lit("T"), F.coalesce(found(folder, r"\d{4}-\d{2}_T(\w+)"), found(folder, r"T(\w+)")))
        return once(F.struct(p["start"].try_cast("int").alias("start"), p["end"].try_cast("int").alias("end"), term_code(p["rest"]).alias("said"), by_folder.alias("by_folder")), whole)

    def whole(p: Column) -> Column:
        start, end, said, by_folder = (p[n] for n in ("start", "end", "said", "by_folder"))
        term = F.when(said.isNull(), by_folder).when((said == "T3") & by_folder.isin("T3A", "T3B"), by_folder).otherwise(said)
        years = F.concat(start.cast("string"), F.lpad(end.cast("string"), 2, "0"))
        return F.struct(
            start.alias("year_start"), F.when(end < 50, 2000 + end).otherwise(1900 + end).alias("year_end"), term.alias("term"), F.concat(F.lit("AY"), years, term).alias("acad_term_id")
        )

    return once(repair_encoding(text), read)


def clean_cell(text: Column, bid: bool = False) -> Column:
    """A table cell: white space collapsed, hard spaces plain, blank as ``-``; a bid's ``-`` as 0."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("None")), r"[\s\u00a0]+", " "))
    t = F.replace(t, F.lit("&nbsp;"), F.lit(" "))
    t = F.when(t.isin("", " "), "-").otherwise(t)
    return F.when(t == "-", "0").otherwise(t) if bid else t


def list_items(html: Column) -> Column:
    """Texts of the ``li`` elements, joined; null without one."""
    items = F.regexp_extract_all(repair_encoding(html), F.lit(r"<li[^>]*>([^<]+)</li>"), 1)
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda x: F.trim(x)), ", "))


def opened_url(script: Column) -> Column:
    """The address that ``window.open`` is called with."""
    return found(script, r"window\.open\('([^']+)'")


def file_ids(path: Column) -> Column:
    """Page file -> struct<acad_term_boss_id int, class_boss_id int> from its name."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.struct(
        found(name, r"SelectedAcadTerm=(\d+)").try_cast("int").alias("acad_term_boss_id"), found(name, r"SelectedClassNumber=(\d+)").try_cast("int").alias("class_boss_id")
    )


def source_term(name: Column) -> Column:
    """Term id within a source's name."""
    return found(name, r"(AY\d{6}T\d+[AB]?)")


def legacy_window(text: Column) -> Column:
    """Window text -> struct<round, window, freshmen, exchange>, the looser reading of older data; no window is -1."""
    return F.struct(
        found(text, r"(?:Round|Rnd) (\d[A-C]?)").alias("round"), F.coalesce(found(text, r"(?:Window|Win) (\d)").try_cast("int"), F.lit(-1)).alias("window"),
        F.coalesce(text.contains("Incoming Freshmen"), F.lit(False)).alias("freshmen"), F.coalesce(text.contains("Incoming Exchange"), F.lit(False)).alias("exchange"),
    )


def legacy_course(code: Column) -> Column:
    """Course code -> struct<subject, number, difficulty int, topic int>: letters, digits at the end, their first and the others."""
    number = found(code, r"(\d+)$")
    digit = lambda g: F.coalesce(F.regexp_extract(number, r"(\d)(\d+)", g).try_cast("int"), F.lit(0))
    return F.struct(found(code, r"([A-Za-z-]+)").alias("subject"), number.alias("number"), digit(1).alias("difficulty"), digit(2).alias("topic"))


def natural_key(text: Column) -> Column:
    """Sort key in which digit runs count as numbers: array<struct<t string, n long>>."""
    pairs = F.filter(F.regexp_extract_all(text, F.lit(r"([^0-9]*[0-9]*)"), 1), lambda p: p != "")
    return F.transform(pairs, lambda p: F.struct(F.lower(F.regexp_extract(p, r"^([^0-9]*)", 1)).alias("t"), F.coalesce(F.regexp_extract(p, r"([0-9]+)$", 1).try_cast("long"), F.lit(-1)).alias("n")))


def is_uuid(text: Column) -> Column:
    form = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return F.coalesce(F.trim(text).rlike(form), F.lit(False))


def stable_id(*parts: Column) -> Column:
    """An identifier in UUID form that is the same whenever the parts are."""
    h = F.md5(F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0002")) for p in parts]))
    dashed = F.regexp_replace(h, r"^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-4$3-a$4-$5")
    return dashed


def safe_int(text: Column) -> Column:
    """Whole number with an optional sign, blanks around it; null for anything else."""
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.regexp_replace(text, r"[\s+]", "").try_cast("int"))


def safe_float(text: Column) -> Column:
    """Number with optional sign, fraction and exponent; null for anything else."""
    return F.when(text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), F.regexp_replace(text, r"\s", "").try_cast("double"))


def date_parts(text: Column, form: str = "yyyy-MM-dd") -> Column:
    """Date text -> struct<day int, month int>; 0 where it isn't a date."""
    at = F.try_to_timestamp(text, F.lit(form))
    return F.struct(F.coalesce(F.dayofmonth(at), F.lit(0)).alias("day"), F.coalesce(F.month(at), F.lit(0)).alias("month"))


def year_range(first: Column, last: Column) -> Column:
    """Terms like 2025-26_T1 and 2028-29_T2 -> the academic years from one to the other."""
    start = lambda t: F.substring(t, 1, 4).try_cast("int")
    years = F.when(start(first) <= start(last), F.sequence(start(first), start(last))).otherwise(F.array().cast("array<int>"))
    return F.transform(years, lambda y: F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0")))


# Windows in the order in which they are held, by era of the term.
INCOMING = (("1F", 1), ("1F", 2), ("1F", 3), ("1F", 4))
LATE_ROUNDS = (("1B", 1), ("1B", 2), ("1C", 1), ("1C", 2), ("1C", 3), ("2", 1), ("2", 2), ("2", 3), ("2A", 1), ("2A", 2), ("2A", 3))
HIERARCHY = {
    "special": (("1", 1), ("1", 2), ("1", 3), ("1", 4), ("2", 1), ("2", 2)),
    "before 2025": (("1", 1), ("1", 2), ("1A", 1), ("1A", 2), *LATE_ROUNDS, *INCOMING),
    "since 2025": (("1", 1), ("1A", 1), ("1A", 2), ("1A", 3), *LATE_ROUNDS, *INCOMING),
}


def window_place(term_id: Column, round_: Column, window: Column) -> Column:
    """Place of a window among those expected in its term; null for others."""
    places = {era: F.create_map(*[F.lit(x) for i, (r, w) in enumerate(held, 1) for x in (f"{r}/{w}", i)]) for era, held in HIERARCHY.items()}
    key = F.concat_ws("/", round_, window.cast("string"))
    end, form = 2000 + F.regexp_extract(term_id, r"^AY\d{4}(\d{2})T", 1).try_cast("int"), r"^AY(\d{4})(\d{2})T(\w+)"
    special = F.regexp_extract(term_id, form, 3).isin("3A", "3B")
    place = lambda era: F.try_element_at(places[era], key)
    return F.when(term_id.rlike(form), F.when(special, place("special")).when(end < 2025, place("before 2025")).otherwise(place("since 2025")))


# The round whose results come out during each window.
TRANSITIONS = ("R1W1", "R1AW1", "R1AW2", "R1AW3", "R1BW1", "R1BW2", "R1CW1", "R1CW2", "R1CW3", "R1FW1", "R1FW2", "R1FW3", "R1FW4", "R2W1", "R2W2", "R2W3", "R2AW1", "R2AW2", "R2AW3")


def window_before(folder: Column) -> Column:
    """Folder like 2025-26_T1_R1AW2 -> struct<round string, window int> of the window before; null for the first and for others."""
    known = F.create_map(*[F.lit(x) for a, b in zip(TRANSITIONS[1:], TRANSITIONS, strict=False) for x in (a, b)])
    before = F.try_element_at(known, F.element_at(F.split(folder, "_"), -1))
    return F.when(before.isNotNull(), F.struct(F.regexp_extract(before, r"^R(\w+)W\d+$", 1).alias("round"), F.regexp_extract(before, r"W(\d+)$", 1).try_cast("int").alias("window")))


DAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
#: Full names of the days.
DAY_NAMES = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")


def day_flags(text: Column) -> dict[str, Column]:
    """has_mon .. has_sun (0 or 1) of a JSON list or comma list of full or three-letter day names."""
    t = F.trim(text)
    json = t.startswith("[") & t.endswith("]")
    listed_days = F.when(json, F.coalesce(F.from_json(t, "array<string>"), F.array().cast("array<string>"))).otherwise(F.split(t, ","))
    days = F.transform(listed_days, lambda d: F.upper(F.trim(d)))
    return {f"has_{short.lower()}": F.coalesce(F.arrays_overlap(days, F.array(F.lit(short), F.lit(full))), F.lit(False)).cast("int") for short, full in zip(DAYS, DAY_NAMES, strict=True)}
