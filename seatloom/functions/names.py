"""Person names as column expressions: two forms of a name, naming patterns, fuzzy likeness."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Surnames that stand first, words that precede a father's name, particles of surnames.
SURNAMES = tuple(
    """WANG LI ZHANG LIU CHEN YANG HUANG ZHAO WU ZHOU XU SUN MA ZHU HU GUO HE LIN GAO LUO CHENG LIANG XIE SONG TANG HAN FENG DENG CAO PENG YUAN SU JIANG JIA LU
    WEI XIAO YU QIAN PAN YAO TAN DU YE TIAN SHI BAI QIN XUE YAN DAI MO CHANG WAN GU ZENG FAN JIN ONG LIM LEE TEO NG GOH CHUA CHAN KOH ANG YEO SIM CHIA CHONG LAM
    CHEW TOH LOW SEAH PEK KWEK QUEK LOH AW CHYE LOK KIM PARK CHOI JEONG KANG CHO YOON JANG OH SEO KWON HWANG JUNG HONG AHN GO MOON SON BAE BAEK HEO NAM
    NGUYEN TRAN LE PHAM HOANG PHAN VU VO DANG BUI DO HO NGO DUONG LY SHARMA SINGH KUMAR GUPTA PATEL KHAN REDDY YADAV DAS JAIN RAO MEHTA CHOPRA KAPOOR
    MALHOTRA AGGARWAL JOSHI MISHRA TRIPATHI PANDEY NAIR MENON PILLAI IYER MUKHERJEE BANERJEE CHATTERJEE SATO SUZUKI TAKAHASHI TANAKA WATANABE ITO YAMAMOTO
    NAKAMURA KOBAYASHI SAITO KATO YOSHIDA YAMADA""".split()
)
PATRONYMIC = ("BIN", "BINTE", "S/O", "D/O")
PARTICLES = ("DE", "DI", "DA", "VAN", "VON", "LA", "LE", "DEL", "DELLA")


def capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1 << 20)))


def among(words: Iterable[str]) -> Column:
    """Words without blanks as an array; one literal, so plans stay small."""
    words = list(words)
    return F.split(F.lit(" ".join(words)), " ") if words else F.array().cast("array<string>")


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bare_words(name: Column) -> Column:
    """Words of a name without what stands in brackets and without initials."""
    plain = F.trim(F.regexp_replace(F.replace(F.trim(name), F.lit("’"), F.lit("'")), r"\s*\(.*\)\s*", " "))
    initial = lambda w: ((F.char_length(w) == 1) & w.rlike(r"^\p{L}$")) | ((F.char_length(w) == 2) & w.endswith("."))
    return F.filter(F.split(plain, r"\s+"), lambda w: (w != "") & ~initial(w))


def normalise(name: Column, given: Iterable[str], surnames: Iterable[str] = SURNAMES) -> Column:
    """Name -> struct<boss_name, display_name>: upper-cased, and capitalised with the surname upper-cased.

    ``given``: western given names. Rules, in order: a name with a comma, a father's name, a known surname beside known given names, else
    the last word.
    """
    given_names, family = among(given), among(surnames)
    known = lambda w: F.array_contains(family, F.upper(w))
    is_given = lambda w: F.array_contains(given_names, F.upper(w))

    def marked(words: Column, at: Column) -> Column:
        """The word at a place upper-cased, with a particle before it; the others capitalised."""
        particle = lambda w, i: (i == at - 1) & F.array_contains(among(PARTICLES), F.upper(w))
        return F.transform(words, lambda w, i: F.when((i == at) | particle(w, i), F.upper(w)).otherwise(capitalised(w)))

    def with_comma(whole: Column) -> Column:
        parts = F.transform(F.split(whole, ","), lambda p: F.trim(p))
        words = F.filter(F.split(F.array_join(parts, " "), r"\s+"), lambda w: w != "")
        first = lambda i: F.get(F.split(F.get(parts, F.lit(i)), r"\s+"), F.lit(0))
        two = F.size(parts) == 2
        surname = F.when(two & known(first(1)), first(1)).when(two & known(first(0)), first(0)).otherwise(F.get(words, F.lit(0)))
        return F.transform(words, lambda w: F.when(F.upper(w) == F.upper(surname), F.upper(w)).otherwise(capitalised(w)))

    def without(words: Column) -> Column:
        n = F.size(words)
        places = F.sequence(F.lit(0), n - 1)
        father = F.get(F.filter(places, lambda i: (i < n - 1) & F.array_contains(among(PATRONYMIC), F.upper(F.get(words, i)))), F.lit(0))
        later = F.get(F.filter(places, lambda i: (i > 0) & known(F.get(words, i))), F.lit(0))
        head = F.get(words, F.lit(0))
        at = (
            F.when(is_given(head), F.coalesce(later, n - 1))
            .when(F.exists(words, is_given) & ~known(head), 0)
            .when(known(head), 0).otherwise(n - 1)
        )
        sons = F.transform(words, lambda w, i: F.when(i == father, F.lower(w)).when(i == father + 1, F.upper(w)).otherwise(capitalised(w)))
        return F.when(n == 1, F.transform(words, capitalised)).when(father.isNotNull(), sons).otherwise(_let(at, lambda a: marked(words, a)))

    def both(words: Column) -> Column:
        whole = F.array_join(words, " ")
        shown = F.when(whole.contains(","), with_comma(whole)).otherwise(F.when(F.size(words) > 0, without(words)))
        return F.struct(F.upper(whole).alias("boss_name"), F.coalesce(F.array_join(shown, " "), F.lit("Unknown")).alias("display_name"))

    unknown = F.struct(F.lit("UNKNOWN").alias("boss_name"), F.lit("Unknown").alias("display_name"))
    return F.when(name.isNull() | (F.trim(name) == ""), unknown).otherwise(_let(bare_words(name), both))


def with_surname(name: Column, surname: Column) -> Column:
    """The name capitalised word by word, its first word equal to the surname upper-cased."""
    parts = F.regexp_extract_all(name, F.lit(r"([ ,]|[^ ,]+)"), 1)

    def shown(parts: Column) -> Column:
        at = F.get(F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.upper(F.get(parts, i)) == F.upper(surname)), F.lit(0))
        return F.array_join(F.transform(parts, lambda p, i: F.when(i == at, F.upper(p)).otherwise(capitalised(p))), "")

    return F.when(F.size(parts) > 0, _let(parts, shown)).otherwise(name)


def pattern(name: Column, given: Iterable[str], surnames: Iterable[str] = SURNAMES) -> Column:
    """WESTERN, ASIAN or, without words, UNKNOWN."""
    words = F.filter(F.split(F.upper(F.trim(name)), r"\s+"), lambda w: w != "")
    given_names, head = among(given), F.get(words, F.lit(0))
    asian = F.array_contains(among(surnames), head) & ~F.arrays_overlap(words, given_names)
    return F.when(name.isNull() | (F.size(words) == 0), "UNKNOWN").when(F.array_contains(given_names, head), "WESTERN").when(asian, "ASIAN").otherwise("WESTERN")


def names_match(a: Column, b: Column) -> Column:
    """Whether all words of the shorter name stand in the longer one."""
    words = lambda c: F.filter(F.split(F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit(" ")), r"\s+"), lambda w: w != "")
    x, y = words(a), words(b)
    return F.when(F.size(x) <= F.size(y), F.size(F.array_except(x, y)) == 0).otherwise(F.size(F.array_except(y, x)) == 0)


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit by bit."""
    row = (1 << len(a)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = row
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _ratio(a: str, b: str) -> float:
    return 200 * _common(a, b) / (len(a) + len(b)) if a or b else 100.0


def _partial(a: str, b: str) -> float:
    """Largest ratio of the shorter text to a stretch of the longer one of at most its length."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    stretches = {long[max(0, i) : i + n] for i in range(1 - n, len(long))}
    return max((_ratio(short, s) for s in stretches), default=0.0)


def _token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    first, second = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(_ratio(first, second), *((_ratio(both, first), _ratio(both, second)) if both else (0.0,)))


def likeness(a: str | None, b: str | None) -> int:
    """0 to 100: 95 where one name holds the other, else the better of the partial and the token-set ratio."""
    if not a or not b:
        return 0
    a, b = (" ".join(t.upper().replace(",", " ").split()) for t in (a, b))
    if a in b or b in a:
        return 95
    return max(round(_partial(a, b)), round(_token_set(a, b)))


@F.pandas_udf(IntegerType())
def fuzzy_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """``likeness`` of two columns of names, in Arrow batches."""
    return pd.Series([likeness(x, y) for x, y in zip(a, b, strict=True)])
