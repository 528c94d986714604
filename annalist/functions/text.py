"""Names, keys and clean-up as Column expressions.

All stay in the JVM. Patterns that must see letters beyond ASCII say (?U).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ligatures, patterns and word lists that decide the results.
LIGATURES = (("œ", "oe"), ("Œ", "Oe"), ("æ", "ae"), ("Æ", "Ae"))
MARKS = r"\p{M}"
ARTICLES = r"\((?:la|le|les|l')\)|^(?:la|le|les|l')\s+|^l'"
LEADING_ARTICLES = r"^(?:la|le|les|l')\s+|\((?:la|le|les|l')\)"
TRAILING_ARTICLE = r"(?i)^(.*?)\s*[({]\s*(la|le|les|l')\s*[)}]\s*$"
SPECKS = r"""(?U)(?<=[\w)\]])(\.(?:\s?\.)*)(?:[jiIl1!{}\\|'"*s]{1,2}|\s[jiIl1!{}\\|'"*]|\s?\[\*\])$"""
NAME_SPELLINGS = (("sainct", "saint"), ("ssweiller", "sweiler"), ("weiller", "weiler"))
OLD_SPELLINGS = (("sainct", "saint"), ("ste-", "sainte-"), ("st-", "saint-"))
LETTER_SPELLINGS = (("y", "i"), ("cq", "c"), ("ck", "c"))
OLD_ENDING = "(?<=[aeiou])(?:lx|ulx|ux)$"


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), 0)


def _decomposed() -> tuple[str, str]:
    """From the rule (compatibility decomposition without marks) for U+00A0 to U+024F: letters that become one other."""
    one, to = "", ""
    for cp in range(0xA0, 0x250):
        c = chr(cp)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != c and len(plain) == 1:
            one, to = one + c, to + plain
    return one, to


_ONE, _TO = _decomposed()


def fold(c: Column, ligatures: bool = True) -> Column:
    """Lower case without accents; `ligatures` also spells out oe and ae (trap T3: two of three callers don't)."""
    for a, b in (LIGATURES if ligatures else ()):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.lower(F.regexp_replace(F.translate(c, _ONE, _TO), MARKS, ""))


def slug(c: Column, ligatures: bool = True) -> Column:
    """Folded, anything but a-z and 0-9 to single hyphens, none at the ends."""
    return F.btrim(F.regexp_replace(fold(c, ligatures), "[^a-z0-9]+", "-"), F.lit("-"))


def name_key(c: Column) -> Column:
    """Loose key of a name: no article, Sainct = Saint, weiller = weiler, letters only, c = e and t = l."""
    f = F.regexp_replace(fold(c), ARTICLES, "")
    for a, b in NAME_SPELLINGS:
        f = F.replace(f, F.lit(a), F.lit(b))
    return F.translate(F.regexp_replace(f, "[^a-z]", ""), "ct", "el")


def geo_key(c: Column) -> Column:
    """`name_key` with b = h as well."""
    return F.replace(name_key(c), F.lit("b"), F.lit("h"))


#: The words that open a qualifying suffix of a compound name.
SUFFIX = r"(?iU)[- ](?:sur|sous|les|lès|lez|en|devant|aux|au|la|le|de|du|des|d'|haut|bas|basse|haute|grand|petit)[- ].*$"


def base_name(c: Column) -> Column:
    """The name without its qualifying suffix."""
    return F.regexp_replace(c, SUFFIX, "")


def fix_name(c: Column) -> Column:
    """First letters that the scan misread: ll, Il, 11 ... before a vowel are H; l before a consonant is I; specks go."""
    vowels = "aeiouyàâäéèêëîïôöûü"
    c = F.regexp_replace(c, f"^(?:ll|Il|li|lI|fl|11|il)(?=[{vowels}])", "H")
    c = F.regexp_replace(c, rf"(?U)^l(?=[^{vowels}\W])", "I")
    return F.regexp_replace(c, "^[.,'’i]+(?=[A-ZÀ-Ý])", "")


def display_name(c: Column) -> Column:
    """An index name as it is shown: article first, note calls and bracketed remarks left out."""
    c = F.btrim(F.regexp_replace(c, r"(?U)[*\d]+(?=\s|$|\()", ""), F.lit(" ,."))
    article = F.regexp_extract(c, TRAILING_ARTICLE, 2)
    stem = F.regexp_extract(c, TRAILING_ARTICLE, 1)
    head = F.concat(F.upper(F.substring(article, 1, 1)), F.lower(F.substring(article, 2, 9)))
    put = F.concat(head, F.when(head.endswith("'"), "").otherwise(" "), stem)
    bare = F.btrim(F.regexp_replace(c, r"\s*[({][^)}]*[)}]?\s*$", ""), F.lit(" ,."))
    return fix_name(F.when(article != "", put).otherwise(F.when(bare == "", c).otherwise(bare)))


def normalize_spaces(c: Column) -> Column:
    c = F.regexp_replace(F.replace(c, F.lit("\xa0"), F.lit(" ")), "[ \t]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r" ([,.)])", "$1"), r"\( ", "("))


#: Particles before which a hyphen at a line's end belongs to a compound name.
PARTICLES = ("sur", "sous", "lès", "les", "lez", "la", "le", "en", "devant", "aux", "au", "de", "du", "des", "et", "am", "an", "bei", "im", "auf", "der", "von")


def dehyphenate(lines: Column) -> Column:
    """Joins an array of lines to a paragraph, undoing hyphenation unless the next word is a compound's part."""

    def step(acc: Column, raw: Column) -> Column:
        line = F.trim(raw)
        first = F.regexp_extract(line, r"(?U)^\w*", 0)
        broken = acc.endswith("-") & ~acc.endswith(" -")
        lower = first.rlike(r"(?U)^\p{Ll}") & ~first.isin(*PARTICLES)
        return (
            F.when(line == "", acc)
            .when(acc == "", line)
            .when(broken & lower, F.concat(F.regexp_replace(acc, "-$", ""), line))
            .when(broken, F.concat(acc, line))
            .otherwise(F.concat(acc, F.lit(" "), line))
        )

    return normalize_spaces(F.aggregate(lines, F.lit(""), step))


def fix_circumflex(c: Column) -> Column:
    """à inside a word, not before a vowel, is â."""
    return F.regexp_replace(c, r"(?U)(?<=[^\W\d_])à(?=[^\W\d_aeouyAEOUY])", "â")


def strip_trailing_specks(c: Column) -> Column:
    """What a scan adds after a line's last full stop."""
    return F.regexp_replace(c, SPECKS, "$1")


def fix_words(c: Column, fixes: dict[str, str]) -> Column:
    """Whole words of a dictionary, in lower, capital or upper case; the case is kept."""
    for wrong, right in fixes.items():
        edge = r"(?<![\p{L}\p{N}_'’-])%s(?![\p{L}\p{N}_'’])"
        upper = right[0].upper() + right[1:]
        for a, b in {wrong: right, wrong[0].upper() + wrong[1:]: upper, wrong.upper(): right.upper()}.items():
            c = F.when(c.contains(a), F.regexp_replace(c, edge % a, b)).otherwise(c)
    return c


def attrs(c: Column) -> Column:
    """"k=v; k2=a|b" as map<string, array<string>>; the last of equal keys counts, empty keys go."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";", -1), lambda p: F.trim(p)), lambda p: F.substring_index(p, "=", 1) != "")
    keys = F.array_distinct(F.transform(parts, lambda p: F.substring_index(p, "=", 1)))
    last = lambda k: F.element_at(F.filter(parts, lambda p: F.substring_index(p, "=", 1) == k), -1)
    value = lambda p: F.when(p.contains("="), F.substr(p, F.instr(p, "=") + 1)).otherwise("")
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.split(value(last(k)), r"\|", -1)))


def page_list(c: Column) -> Column:
    """"34-36;116" as the array of pages."""
    return F.flatten(
        F.transform(F.split(c, r";\s*"), lambda p: F.sequence(F.substring_index(p, "-", 1).cast("int"), F.substring_index(p, "-", -1).cast("int")))
    )


def entry_number(c: Column) -> Column:
    """The number of an entry, null for items without one."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def share_value(c: Column) -> Column:
    """"n/d" as struct<num, den>; null for part, joint and missing shares."""
    return F.when(c.rlike("^[0-9]+/[0-9]+$"), F.struct(F.substring_index(c, "/", 1).cast("bigint").alias("num"), F.substring_index(c, "/", -1).cast("bigint").alias("den")))


def to_roman(n: Column) -> Column:
    """Roman numerals up to 39 (page labels)."""
    out = F.repeat(F.lit("X"), F.floor(n / 10).cast("int"))
    ones = F.array(*map(F.lit, ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")))
    return F.concat(out, F.get(ones, (n % 10).cast("int")))


#: Digit pairs that the scan confuses, for number variants (nine) and for alignment (eleven; trap T4).
CONFUSED_VARIANTS = ("35", "14", "17", "56", "68", "38", "06", "09", "05")
CONFUSED_ALIGNMENT = ("35", "14", "17", "56", "68", "38", "69", "05", "09", "06", "89")


def _at(s: Column, i: Column) -> Column:
    return F.substring(s, i, F.lit(1))


def digit_variants(n: Column) -> Column:
    """Numbers that differ from n in one confusable digit, sorted; no leading zero, not n itself."""
    s = n.cast("string")
    pairs = [(a, b) for p in CONFUSED_VARIANTS for a, b in (p, p[::-1])]

    def at(i: Column) -> Column:
        swapped = [F.when(_at(s, i) == a, F.concat(F.substring(s, F.lit(1), i - 1), F.lit(b), F.substr(s, i + 1))) for a, b in pairs]
        return F.filter(F.array(*swapped), lambda v: v.isNotNull() & ~v.startswith("0"))

    found = F.flatten(F.transform(F.sequence(F.lit(1), F.length(s)), at))
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda v: v.cast("bigint")), lambda v: v != n)))


def digit_neighbours(n: Column) -> Column:
    """Numbers one digit away: one changed, added or dropped; sorted, no leading zero, not n itself."""
    s = n.cast("string")
    digits = F.array(*[F.lit(str(d)) for d in range(10)])

    def at(i: Column) -> Column:
        head, tail = F.substring(s, F.lit(1), i - 1), F.substr(s, i)
        rest = F.substr(s, i + 1)
        added = F.transform(digits, lambda d: F.concat(head, d, tail))
        inside = i <= F.length(s)
        changed = F.when(inside, F.transform(digits, lambda d: F.concat(head, d, rest))).otherwise(F.array().cast("array<string>"))
        dropped = F.when(inside, F.array(F.concat(head, rest))).otherwise(F.array().cast("array<string>"))
        return F.concat(added, changed, dropped)

    found = F.flatten(F.transform(F.sequence(F.lit(1), F.length(s) + 1), at))
    kept = F.filter(found, lambda v: (v != "") & ~v.startswith("0"))
    return F.array_sort(F.array_distinct(F.filter(F.transform(kept, lambda v: v.cast("bigint")), lambda v: v != n)))


def loose_numbers(n: Column) -> Column:
    """The numbers that read as n at an alignment cost of 1.0 at most: up to three confused digits, one other digit, or
    one digit more or less and one confused; without leading zero, n itself included."""
    others = {d: [x[1 - x.index(d)] for x in CONFUSED_ALIGNMENT if d in x] for d in "0123456789"}
    swaps = F.create_map(*[x for d, o in others.items() for x in (F.lit(d), F.array(*map(F.lit, o)).cast("array<string>"))])
    places = lambda s: F.sequence(F.lit(1), F.length(s))
    put = lambda s, i, d: F.concat(F.substring(s, F.lit(1), i - 1), d, F.substr(s, i + 1))
    confused = lambda words: F.array_distinct(F.flatten(F.transform(words, lambda s: F.flatten(F.transform(places(s), lambda i: F.transform(F.element_at(swaps, _at(s, i)), lambda d: put(s, i, d)))))))
    digits = F.array(*[F.lit(str(d)) for d in range(10)])
    own = F.array(n.cast("string"))
    other = F.flatten(F.transform(own, lambda s: F.flatten(F.transform(places(s), lambda i: F.transform(digits, lambda d: put(s, i, d))))))
    less = F.filter(F.flatten(F.transform(own, lambda s: F.transform(places(s), lambda i: put(s, i, F.lit(""))))), lambda s: s != "")
    more = F.flatten(F.transform(own, lambda s: F.flatten(F.transform(F.sequence(F.lit(0), F.length(s)), lambda i: F.transform(digits, lambda d: F.concat(F.substring(s, F.lit(1), i), d, F.substr(s, i + 1)))))))
    one = let(F.array_distinct(F.concat(less, more)), lambda x: F.concat(x, confused(x)))
    # each digit is confused once, from left to right
    level = lambda states: F.flatten(F.transform(states, lambda x: F.flatten(F.transform(F.filter(places(x["s"]), lambda i: i > x["at"]), lambda i: F.transform(F.element_at(swaps, _at(x["s"], i)), lambda d: F.struct(put(x["s"], i, d).alias("s"), i.alias("at")))))))
    texts = lambda states: F.transform(states, lambda x: x["s"])
    first = F.transform(own, lambda s: F.struct(s.alias("s"), F.lit(0).alias("at")))
    three = let(level(first), lambda a: let(level(a), lambda b: F.concat(texts(a), texts(b), texts(level(b)))))
    found = F.filter(F.array_distinct(F.concat(own, other, one, three)), lambda s: ~s.startswith("0"))
    return F.transform(found, lambda s: s.cast("bigint"))


def expand_numbers(tokens: Column) -> Column:
    """Abbreviated numbers and ranges in full: 1537, 38 is 1537, 1538; 709-715 is the range (E5)."""

    def full(n: Column, prev: Column, inclusive: bool) -> Column:
        width = F.length(n)
        p = prev.cast("string")
        v = F.concat(F.substring(p, F.lit(1), F.length(p) - width), n).cast("bigint")
        step = F.pow(F.lit(10), width).cast("bigint")
        ok = (v > prev) | (v == prev) if inclusive else v > prev
        short = prev.isNotNull() & (F.length(n.cast("bigint").cast("string")) < F.length(p))
        return F.when(~short, n.cast("bigint")).when(ok, v).otherwise(v + step)

    def step(acc: Column, tok: Column) -> Column:
        bare = lambda x: x.cast("bigint").cast("string")
        start = full(bare(F.substring_index(tok, "-", 1)), acc["prev"], False)
        end = F.when(tok.contains("-"), full(bare(F.substring_index(tok, "-", -1)), start, True)).otherwise(start)
        run = F.when(end >= start, F.sequence(start, end)).otherwise(F.array(start))
        return F.struct(end.alias("prev"), F.concat(acc["out"], run).alias("out"))

    zero = F.struct(F.lit(None).cast("bigint").alias("prev"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(tokens, zero, step, lambda acc: acc["out"])


def spelling_key(c: Column) -> Column:
    """Old and modern spellings together: no articles, Sainct = Saint, y = i, doubled letters single, endings dropped."""
    f = F.regexp_replace(fold(c), LEADING_ARTICLES, "")
    for a, b in OLD_SPELLINGS:
        f = F.replace(f, F.lit(a), F.lit(b))
    f = F.regexp_replace(f, "[^a-z]", "")
    for a, b in LETTER_SPELLINGS:
        f = F.replace(f, F.lit(a), F.lit(b))
    f = F.regexp_replace(f, r"(.)\1+", "$1")
    return F.regexp_replace(F.regexp_replace(f, OLD_ENDING, "l"), "[sxz]$", "")


#: Letter groups, then letters, that a coarse key makes equal.
COARSE_GROUPS = (("fl", "h"), ("li", "h"), ("rn", "m"), ("ii", "u"), ("cl", "d"))
COARSE_FROM, COARSE_TO = "eoauictbhfsnmrjyvq", "eeeeiilhhssnnnilug"


def coarse(key: Column) -> Column:
    for a, b in COARSE_GROUPS:
        key = F.replace(key, F.lit(a), F.lit(b))
    return F.translate(key, COARSE_FROM, COARSE_TO)


def bigrams(key: Column) -> Column:
    """The different letter pairs of a key."""
    n = F.length(key)
    return F.when(n >= 2, F.array_distinct(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(key, i, F.lit(2))))).otherwise(F.array().cast("array<string>"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of 6371 km."""
    h = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return F.lit(2 * 6371) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def laea(lat: Column, lon: Column) -> tuple[Column, Column]:
    """WGS84 degrees to EPSG:3035 metres: Lambert azimuthal equal area on GRS80, centre 52 N 10 E."""
    import math

    a, f = 6378137.0, 1 / 298.257222101
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q_of(s, log):
        return (1 - e2) * (s / (1 - e2 * s * s) - log((1 - e * s) / (1 + e * s)) / (2 * e))

    q_pole, s0 = q_of(1.0, math.log), math.sin(math.radians(52))
    b0 = math.asin(q_of(s0, math.log) / q_pole)
    rq = a * math.sqrt(q_pole / 2)
    d = a * (math.cos(math.radians(52)) / math.sqrt(1 - e2 * s0 * s0)) / (rq * math.cos(b0))
    q = q_of(F.sin(F.radians(lat)), F.log)
    b, dl = F.asin(q / q_pole), F.radians(lon - 10)
    k = rq * F.sqrt(2 / (1 + math.sin(b0) * F.sin(b) + math.cos(b0) * F.cos(b) * F.cos(dl)))
    return 4321000 + k * d * F.cos(b) * F.sin(dl), 3210000 + k / d * (math.cos(b0) * F.sin(b) - math.sin(b0) * F.cos(b) * F.cos(dl))


def ramp_colour(share: Column, low: tuple[int, int, int] = (237, 248, 233), high: tuple[int, int, int] = (0, 109, 44)) -> Column:
    """A share of the maximum on a square-root ramp, as #rrggbb."""
    t = F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
    return F.format_string("#%02x%02x%02x", *[F.round(a + (b - a) * t).cast("int") for a, b in zip(low, high)])
