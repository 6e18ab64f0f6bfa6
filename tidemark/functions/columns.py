"""Column expressions shared by the operators. All stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of the supported alphabets, and what separates words.
RUSSIAN = "А-Яа-я"
KAZAKH = "ӘәҒғҚқҢңӨөҰұҮүІі"
_ASCII_OTHER = "".join(f"\\x{i:02x}" for i in range(128) if not chr(i).isalpha() and chr(i) != "-")
NOT_WORD = f"([^{RUSSIAN}a-zA-Z{KAZAKH}-]|[^ ]*[*][^ ]*)"


def q6(x: Column) -> Column:
    """Six decimals, with the tie moved off natural values so that other engines round alike."""
    return F.floor(x.cast("double") * F.lit(1e6) + F.lit(0.50001)) / F.lit(1e6)


def cleaned_words(text: Column) -> Column:
    """Words of the supported alphabets in lower case; null stays null.

    The same as replacing each match of ``NOT_WORD`` by a blank, in linear time: where a ``*`` follows a run's first
    letter, all from that letter to the run's end goes; only texts that hold a ``*`` are searched for such runs. Other ASCII
    characters go first, by a class of single characters, which Java looks up in a table; the class of all letters, some
    twenty tests for each character, is only asked about what is neither ASCII nor Russian.
    """
    letter = f"{RUSSIAN}a-zA-Z{KAZAKH}-"
    starred = F.regexp_replace(text, f"(?<![^ ])[^ {letter}]*+[{letter}][^ *]*+[*][^ ]*+", " ")
    bare = F.regexp_replace(F.when(F.contains(text, F.lit("*")), starred).otherwise(text), f"[{_ASCII_OTHER}]+", " ")
    wide = F.regexp_replace(bare, f"(?=[^\\x00-\\x7f])(?![{RUSSIAN}])[^{letter}]", " ")
    bare = F.when(F.octet_length(bare) == F.length(bare), bare).otherwise(wide)
    return F.array_remove(F.split(F.trim(F.lower(bare)), " +"), "")


def clean(text: Column) -> Column:
    """Words of the supported alphabets in lower case, one space between; null stays null."""
    return F.array_join(cleaned_words(text), " ")


def words(cleaned: Column) -> Column:
    return F.filter(F.split(cleaned, " "), lambda w: w != "")


def letter_share(text: Column, letters: str) -> Column:
    """Share of characters in a class; 0 for an empty text."""
    n = F.length(text)
    return F.when(n > 0, F.length(F.regexp_replace(text, f"[^{letters}]", "")) / n).otherwise(F.lit(0.0))


def is_word(text: Column) -> Column:
    return letter_share(text, f"a-zA-Z{RUSSIAN}ёЁ") > 0.5


def is_kazakh(text: Column) -> Column:
    return letter_share(text, KAZAKH) > 0.05


def is_latin(text: Column, share: float = 0.51) -> Column:
    return letter_share(text, "a-zA-Z") > share


def ngrams(tokens: Column, n: int) -> Column:
    """n neighbouring tokens joined by ``_``, in order."""
    spans = F.sequence(F.lit(0), F.size(tokens) - n)
    return F.when(F.size(tokens) >= n, F.transform(spans, lambda i: F.array_join(F.slice(tokens, i + 1, n), "_"))).otherwise(
        F.array().cast("array<string>")
    )


def jaccard(a: Column, b: Column) -> Column:
    """Of two lists: distinct common elements over both lengths less those; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def overlap_distance(a: Column, b: Column) -> Column:
    """1 - common elements over the smaller set's."""
    return F.lit(1.0) - F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))


def min_max(x: Column, lowest: Column, highest: Column, a: float = 0.0, b: float = 1.0) -> Column:
    """Scale [lowest, highest] to [a, b]; an empty range counts as 1."""
    return (x - lowest) / F.when(highest == lowest, F.lit(1.0)).otherwise(highest - lowest) * (b - a) + a


def slug(text: Column) -> Column:
    """Cyrillic to Latin, Kazakh letters dropped, lower case, only letters, digits and ``_.-``; blanks become ``_``."""
    low = F.lower(text)
    # Letters that become several.
    for one, many in (("ж", "zh"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("щ", "shch"), ("ю", "yu"), ("я", "ya"), ("ё", "yo")):
        low = F.replace(low, F.lit(one), F.lit(many))
    low = F.translate(low, "абвгдезийклмнопрстуфыэьъ", "abvgdeziyklmnoprstufye")
    return F.regexp_replace(F.regexp_replace(low, r"\s+", "_"), r"[^a-z0-9_.\-]", "")


def safe_int(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def short_title(text: Column, most: int = 150) -> Column:
    return F.concat(F.substring(text, 1, most), F.when(F.length(text) > most, F.lit("...")).otherwise(F.lit("")))


def hashtags(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, r"\s+"), lambda w: w.startswith("#") & (F.length(w) > 1)), lambda w: F.substring(w, 2, 1_000_000))


def keyword_hits(text: Column, query: str) -> Column:
    """How many alternatives of ``a | b`` occur as substrings."""
    parts = [p.strip() for p in query.split("|")]
    hits = [F.when(F.contains(text, F.lit(p)), 1).otherwise(0) for p in parts]
    out = hits[0]
    for h in hits[1:]:
        out = out + h
    return out


def url_key(url: Column) -> Column:
    """Scheme and slashes dropped."""
    return F.replace(F.regexp_replace(url, "^https?:", ""), F.lit("/"), F.lit(""))


# Fixed value: the alphabet of short codes.
CODE_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"


def code_to_id(code: Column) -> Column:
    return F.aggregate(F.split(code, ""), F.lit(0).cast("long"), lambda a, c: a * 64 + F.when(c == "", 0).otherwise(F.instr(F.lit(CODE_ALPHABET), c) - 1))


def id_to_code(number: Column, digits: int = 11) -> Column:
    """Base 64, most significant first, without leading zeros (one digit at least)."""
    each = [F.substring(F.lit(CODE_ALPHABET), (F.shiftrightunsigned(number, 6 * i).bitwiseAND(63) + 1).cast("int"), F.lit(1)) for i in reversed(range(digits))]
    return F.regexp_replace(F.concat(*each), "^A+(?=.)", "")


def parse_iso(text: Column) -> Column:
    """ISO time with or without a fraction; a zone's colon is dropped; null if neither fits."""
    bare = F.regexp_replace(text, r"([+-]\d\d):(\d\d)$", "$1$2")
    forms = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.S", "yyyy-MM-dd'T'HH:mm:ss")
    return F.coalesce(*(F.try_to_timestamp(bare, F.lit(f)) for f in forms)).cast("timestamp_ntz")


def swap_day_month(day: Column, today: Column) -> Column:
    """A date in the future whose day may be a month was read the wrong way round."""
    return F.when((day > today) & (F.dayofmonth(day) <= 12), F.make_date(F.year(day), F.dayofmonth(day), F.month(day))).otherwise(day)


def _last_year(day: Column, today: Column) -> Column:
    """A month of this year that is yet to come was last year's."""
    late = (F.year(day) == F.year(today)) & (F.month(day) > F.month(today))
    return F.when(late, F.add_months(day, -12)).otherwise(day)


def roll_back(day: Column, today: Column) -> Column:
    """``_last_year``; dates before 2000 are null."""
    return F.when(F.year(day) >= 2000, _last_year(day, today))


def epoch_local(seconds: Column) -> Column:
    """Seconds since 1970 as local time, six hours behind UTC."""
    return (F.timestamp_seconds(seconds) - F.expr("INTERVAL 6 HOURS")).cast("timestamp_ntz")


def long_words(text: Column, least: int = 3) -> Column:
    """Lower case without tags; words of ``least`` characters or more, one space between; no ``_`` and no byte order mark."""
    bare = F.regexp_replace(F.lower(text), "<[^>]++>", "")
    kept = F.array_join(F.filter(F.split(bare, r"\s+"), lambda w: F.length(w) >= least), " ")
    return F.replace(F.replace(kept, F.lit("_"), F.lit("")), F.lit("\ufeff"), F.lit(""))


def comments(edges: Column) -> Column:
    """(text, created_at, id) of each comment of ``edges`` (array of struct node), followed by its replies."""
    node = lambda n: F.struct(n["text"].alias("text"), n["created_at"].alias("created_at"), n["id"].alias("id"))

    def with_replies(e: Column) -> Column:
        n = e["node"]
        replies = F.transform(n["edge_threaded_comments"]["edges"], lambda r: node(r["node"]))
        return F.concat(F.array(node(n)), F.coalesce(replies, F.array().cast("array<struct<text:string,created_at:bigint,id:string>>")))

    return F.flatten(F.transform(edges, with_replies))


# Phrases around dates, and the months' names.
DATE_PHRASES = ["опубликовано:", "автор:", "автор", "мск", "(-ов)"]
MONTHS = ["янв", "фев", "мар", "апр", "ма[йя]", "июн", "июл", "авг", "сен", "окт", "ноя", "дек"]


def russian_date(text: Column, today: Column) -> Column:
    """Day of a date in words (``5 марта 2021, 10:00``, ``сегодня``, ``вчера``) or digits (``05.03.2021``).

    Without a year it is of this year; a month after today's is of last year then. Years before 2000, and what is no date,
    are null.
    """
    low = F.lower(text)
    for phrase in DATE_PHRASES:
        low = F.replace(low, F.lit(phrase), F.lit(""))
    part = lambda pattern, i: F.regexp_extract(low, pattern, i).try_cast("int")
    month = F.coalesce(*(F.when(low.rlike(rf"\d\s+{m}"), F.lit(i)) for i, m in enumerate(MONTHS, 1)))
    in_words, digits = r"(\d{1,2})\s+[а-я]+\.?(?:\s+(\d{4}))?", r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
    made = lambda *ymd: F.concat(ymd[0], F.lit("-"), ymd[1], F.lit("-"), ymd[2]).try_cast("date")
    named = made(F.coalesce(part(in_words, 2), F.year(today)), month, part(in_words, 1))
    plain = made(part(digits, 3), part(digits, 2), part(digits, 1))
    day = F.when(low.contains("сегодня"), today).when(low.contains("вчера"), F.date_sub(today, 1)).otherwise(F.coalesce(named, plain))
    return roll_back(day, today)
