"""Rule lists and ladders as Column expressions.

The lists are fixed values; what reads them is generic: a first match, all matches, or a ladder of conditions. Patterns
without capitals are matched against folded text (lower case, no accents, ligatures kept apart).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from annalist.functions import text

# --- fixed values: the patterns that classify entries, headings, sections and series -----------------------------

DESCRIPTORS = (
    ("castle", r"\b[ce][hb]as[tl]eaux?\b|\bchasteau|\bmaison forte"),
    ("town", r"\bvilles?\b(?! de)"),
    ("small_town", r"\bbourgs?\b"),
    ("village", r"\bvillages?\b"),
    ("hamlet", r"\bhameau"),
    ("abbey", r"\babba[iy]e"),
    ("priory", r"\bprieure"),
    ("collegiate_church", r"collegia"),
    ("convent", r"\bcouvent|\bmonastere"),
    ("commandery", r"\bcommanderie"),
    ("hospital", r"\bhospital|\bhopital"),
    ("farmstead", r"\bcen[sc]e\b"),
    ("grange", r"\bgagnage"),
    ("glassworks", r"\bverrerie"),
    ("saltworks", r"\bsalines?\b"),
    ("mill", r"\bmoulin"),
    ("mine", r"\bm[iy]nes?\b"),
    ("market", r"\bmarche\b"),
    ("passage", r"\bpassage"),
    ("pleasure_house", r"maison de plaisir"),
    ("palace", r"\bpalais\b"),
    ("deserted_village", r"\bruine|\bruyne|\bdestruict"),
)
ORDERS = (
    ("benedictine", r"sainct\s*be[nm]oi|saint\s*beno|benoist|benedict"),
    ("cistercian", r"ciste?aux?|citeaux|cisteau"),
    ("premonstratensian", r"premon?str"),
    ("augustinian", r"augustin|chanoines? regulier"),
    ("cluniac", r"\bcluny"),
    ("carthusian", r"chartreu"),
    ("poor_clares", r"\bclar[ei]|saincte[- ]claire"),
    ("franciscan", r"cordelier|sainct[- ]francois|observance"),
    ("dominican", r"prescheu|prescheresse|dominic"),
    ("minim", r"\bminimes?\b"),
    ("capuchin", r"capuc"),
    ("jesuit", r"jesu[iy]t"),
    ("antonine", r"sainct[- ]anthoine|antonin"),
    ("hospitaller", r"sainct[- ]jean de h|hierusalem|malte"),
    ("teutonic", r"teuton"),
)
#: What an entry must speak of before an order is looked for.
RELIGIOUS = r"ordre|abba|prieur|couvent|cordelier|jesu"
SECTIONS = (
    ("safeguard", r"sauvegardes?\b"),
    ("clergy", r"\bclerge\b|^cierge\b|^villages? dependan"),
    ("fief", r"\bfi[ec]d[vr][ec]\S?\b|\bfi[ec]dv"),
    ("domain", r"\bdo[mr][oa]?[a-z]?ine\b"),
)
SERIES = (
    ("towns", r"^noms des villes"),
    ("cathedrals", r"^eglises? cathedrale"),
    ("collegiates", r"^eglises? collegia"),
    ("abbeys_m", r"^abbayes de religieux"),
    ("abbeys_f", r"^abbayes de dames"),
    ("convents_f", r"^couven\S* de religieuses"),
    ("grey_sisters", r"^s[oœ]e?urs grises"),
    ("other_sisters", r"^autres s[oœ]e?urs"),
    ("priories", r"^prieur"),
    ("friaries", r"^couven\S* de cordelier"),
    ("convents_m", r"^couven\S* d'autres religieux"),
    ("commanderies", r"^c[o0]r?n?m+anderies"),
    ("charterhouses", r"chartreuse"),
)
#: Words of a heading: type, hierarchy, level, pattern.
DIVISIONS = (
    ("bailiwick", "admin", 1, r"^bailliage\b"),
    ("provostship", "admin", 2, r"\bp[rli]e?v[o]s[tl]e"),
    ("office", "admin", 2, r"\bo[f][fl]?[il1]c[ec]\b"),
    ("castellany", "admin", 2, r"\b[ce][hb]as[tl][ec][lu]{1,2}a?[il]n|\bchastell?enie|\bchastelkunie"),
    ("receivership", "admin", 2, r"\brecep?te\b"),
    ("town_district", "admin", 2, r"^(?:la |les )?villes? (?:de|et)\b"),
    ("district", "admin", 3, r"\bsergenterie\b"),
    ("ban", "admin", 3, r"(?:^|\s)(?:le |les )?bans?\b"),
    ("mayoralty", "admin", 3, r"\bmairies?\b"),
    ("court", "admin", 3, r"^(?:la )?court de\b"),
    ("val", "admin", 3, r"^(?:le )?val\b"),
    ("county", "feudal", 2, r"\bcomte\b"),
    ("barony", "feudal", 2, r"\bbaronn?ie\b"),
    ("lordship", "feudal", 2, r"\bseigneur[i1]es?\b|^(?:la |les )?terres?\b|\bterres? et\b"),
)
#: Of several types of a heading the first in these orders counts.
ADMIN_ORDER = ("bailiwick", "provostship", "office", "castellany", "town_district", "receivership", "val", "district", "court", "ban", "mayoralty", "sub_provostship", "landschultheisserei")
FEUDAL_ORDER = ("county", "barony", "lordship", "fief", "temporality")
VERBS = r"\b(?:est|sont|dependent|appartien\S*|ensuivent|se tirent|se voit|souloit|meuvent)\b"
GLUED = r"(ainie|ainies|ost[ée]|ost[ée]z|eurie|euries|mairie|comt[ée])(de|d'|et|du)(?=\s|[A-ZÀ-Ý']|$)"
SEAT_END = r",|\s+s[cçr]av[oc]i[rt]\b|:|\s+comme dessus|\s+audict\b|\s+partie\b|\s+(?:tenu|lentiz|despendant|d[ée]pendant)\b"
BEFORE_SEAT = r"^\s*(?:et\s+\S+\s+)*?(?:de la |des |du |de |d['’]\s*|le |la )"
HOLDER = r"(?i)(?:tenu[sz]?|lentiz|tenir) en fi[ec]d.*?\bpar\s+(.+)$|tenir en fi[ec]d\S* d\S+ .*? (les seigneur.+)$"
HALF, PART = r"pour (?:la|une) moic?tie|par moic?tie|moic?tie (?:a|au)", r"\b(?:en |pour une |pour )?partie\b"
NUMERALS = {"une": 1, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "six": 6, "sept": 7, "huit": 8}

# --- fixed values: the lists that classify places and territories -------------------------------------------------

KIND_TYPES = (
    ("deserted_village", r"detr|detruit"),
    ("hamlet", r"^ham|\bham\."),
    ("farmstead", r"\bcen[sc]e|ferme"),
    ("mill", r"moulin"),
    ("glassworks", r"verrerie"),
    ("grange", r"gagnage"),
    ("abbey", r"^anc\. abbaye|^abbaye"),
    ("priory", r"^anc\. prieur|^prieur"),
)
UNLOCATED = ("Bans", "Fiefs", "Granges (gagnages)", "Glassworks", "Deserted villages", "Towns and religious houses (the lists)", "Villages and others")
REALM_GROUPS = {
    "bailiwick": "bailiwick", "provostship": "office", "sub_provostship": "office", "castellany": "office", "office": "office", "district": "office",
    "town_district": "office", "lordship": "lordship", "fief": "lordship", "county": "county",
}
GROUP_ORDER = ("bailiwick", "office", "county", "lordship", "other")
ADMIN_LEVELS = {
    "bailiwick": 1, "provostship": 2, "sub_provostship": 2, "castellany": 2, "office": 2, "district": 2, "town_district": 2, "court": 3, "ban": 3, "mayoralty": 3, "val": 3,
}
SHARES = {"part": "in part", "1/2": "half", "joint": "jointly"}

# --- generic readers ----------------------------------------------------------------------------------------------


def folded(c: Column) -> Column:
    return text.fold(c, ligatures=False)


def first_match(c: Column, patterns) -> Column:
    """The key of the first pattern that matches, else null."""
    return F.coalesce(*[F.when(c.rlike(p), key) for key, p in patterns])


def all_matches(c: Column, patterns) -> Column:
    """The keys of all patterns that match, in the list's order."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), key) for key, p in patterns]))


def ladder(steps, other=None) -> Column:
    """The value of the first condition that holds; a null condition doesn't."""
    return reduce(lambda below, step: F.when(step[0], step[1]).otherwise(below), reversed(list(steps)), F.lit(other) if not isinstance(other, Column) else other)


def look_up(c: Column, table: dict, other=None) -> Column:
    """A value of a small literal table."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, c), F.lit(other))


def rank_in(c: Column, order) -> Column:
    """The place of a value in an order from 0, after all of them if it is not there."""
    at = F.array_position(F.array(*map(F.lit, order)), c)
    return F.when(F.coalesce(at, F.lit(0)) == 0, len(order)).otherwise(at - 1).cast("int")


# --- entries (H15) ----------------------------------------------------------------------------------------------


def entry_name(c: Column) -> Column:
    """What stands before the first comma, bracket or closing full stop."""
    return text.fix_name(F.btrim(F.get(F.split(c, r",|\s+\(|\.\s*$", 2), 0), F.lit(" .")))


def entry_descriptors(c: Column) -> Column:
    """What the words after the first comma say the place is; "La ville de ..." is a town by itself."""
    after = F.when(c.contains(","), folded(F.substr(c, F.instr(c, ",") + 1))).otherwise("")
    town = F.when(folded(c).rlike("^la ville d"), F.array(F.lit("town"))).otherwise(F.array().cast("array<string>"))
    found = all_matches(after, DESCRIPTORS)
    return F.when(F.array_contains(found, "town"), found).otherwise(F.concat(town, found))


def entry_order(c: Column, listed: Column) -> Column:
    """The religious order, for texts that speak of a house and for entries of the lists."""
    return F.when(folded(c).rlike(RELIGIOUS) | listed, first_match(folded(c), ORDERS))


def entry_share(c: Column) -> Column:
    """struct<share, words>: half, part or null, and the words from there on."""
    f = folded(c)
    tail = lambda p: F.btrim(F.substr(c, F.length(F.regexp_extract(f, rf"^(.*?)(?:{p})", 1)) + 1), F.lit(" ."))
    return (
        F.when(f.rlike(HALF), F.struct(F.lit("1/2").alias("share"), tail(HALF).alias("words")))
        .when(f.rlike(PART), F.struct(F.lit("part").alias("share"), tail(PART).alias("words")))
        .otherwise(F.struct(F.lit(None).cast("string").alias("share"), F.lit("").alias("words")))
    )


def holder_words(c: Column) -> Column:
    """Who is said to hold it in fee, else empty."""
    a, b = F.regexp_extract(c, HOLDER, 1), F.regexp_extract(c, HOLDER, 2)
    return F.btrim(F.when(a != "", a).otherwise(b), F.lit(" ."))


# --- headings (H16) -----------------------------------------------------------------------------------------------


def section_of(c: Column) -> Column:
    """The section that a short line opens, else null."""
    f = folded(c)
    return F.when(F.length(f) <= 90, first_match(f, SECTIONS))


def seat_of(c: Column, skip: Column) -> Column:
    """The place that a heading is named after: what follows its type words, `skip` characters, up to a comma or a verb."""
    rest = F.get(F.split(F.substr(F.regexp_replace(c, GLUED, "$1 $2"), skip + 1), SEAT_END), 0)
    return F.btrim(F.regexp_replace(F.trim(rest), BEFORE_SEAT, ""), F.lit(" .,;:"))


def heading(c: Column, before_entry: Column) -> Column:
    """struct<admin, feudal, level, seat, pair> of a territory heading, null for prose.

    A heading is short, has no verb and does not end with a comma (unless an entry follows); its type words stand
    within its first 60 characters.
    """
    f = folded(F.regexp_replace(c, GLUED, "$1 $2"))
    prose = (F.length(f) > 160) | (F.rtrim(c).endswith(",") & ~before_entry) | f.rlike(VERBS)
    at = lambda p: F.length(F.regexp_extract(f, rf"^(.*?)(?:{p})", 1))
    stop = lambda p: F.length(F.regexp_extract(f, rf"^.*?(?:{p})\S*", 0))
    hits = F.array_compact(F.array(*[F.when(f.rlike(p) & (at(p) < 60), F.struct(F.lit(t).alias("type"), F.lit(h).alias("h"), F.lit(lv).alias("level"), stop(p).alias("stop"))) for t, h, lv, p in DIVISIONS]))

    def read(found: Column) -> Column:
        best = lambda h, order: F.array_min(F.transform(F.filter(found, lambda x: x["h"] == h), lambda x: F.struct(rank_in(x["type"], order).alias("r"), x["type"].alias("type"), x["level"].alias("level"))))
        a, b = best("admin", ADMIN_ORDER), best("feudal", FEUDAL_ORDER)
        end = F.array_max(F.transform(found, lambda x: x["stop"]))
        kinds = F.array_compact(F.array(a["type"], b["type"]))
        level = F.array_min(F.transform(F.filter(found, lambda x: F.array_contains(kinds, x["type"])), lambda x: x["level"]))
        return F.struct(a["type"].alias("admin"), b["type"].alias("feudal"), level.alias("level"), seat_of(c, end).alias("seat"), (a.isNotNull() & b.isNotNull()).alias("pair"))

    return text.let(hits, lambda found: F.when(~prose & (F.size(found) > 0), read(found)))


def letters(c: Column) -> Column:
    return F.regexp_replace(folded(c), "[^a-z0-9]", "")


# --- corrections (H14) ----------------------------------------------------------------------------------------------

#: The wordings of the editor's instructions; of pairs of groups the first is old unless said otherwise.
_LIEU = r"a[nu] (?:lieu|heu) de\s+"
_WORD = r"[A-ZÀ-Ýl][\w'’\-]+"
NUMBER_FOR = rf"(?i)lisez\s*:?\s*(\d{{3,4}}),?\s+{_LIEU}(\d{{3,4}})"  # new, old
FOR_NUMBER = rf"(?i){_LIEU}(\d{{3,4}}),?\s+lisez\s*:?\s*(\d{{3,4}})"  # old, new
ADD_NUMBER = rf"(?U)ajoutez à l'art\.?\s*({_WORD}) le n\S*\s*(\d{{3,4}})"  # article, new
NUMBER_NOT = r"au n\S*\s*(\d{3,4}),?\s+e[lt] non au\s+(\d{3,4})"  # new, old
ONLY_NUMBER = r"ne doit porter que le n\S*\s*(\d{3,4})\s*;\s*le\s+(\d{3,4})"  # new, old
READ_FOR = rf"(?i){_LIEU}(.+?),?\s+lisez\s*:?\s*(.+?)\.?$"
ACTIONS = (
    ("renumber", r"doit correspondre|ne doit porter que|le n[°o\"]+\s*\d|numéro doit être effacé"),
    ("replace", r"rétabli|remplacé par le suivant|doit être remplacé"),
    ("add", r"ajoutez|mettez|menez|placez|intercalez|en t[eê]te de la lettre"),
    ("delete", r"supprimez|effacez|supprimés|est à effacer"),
    ("move", r"doit venir|reportez"),
    ("note", r"accompagné de cette note|voy\. la note"),
)
VERB_FIRST = r"(?iU)^(?:lisez|ajoutez|mettez|menez|placez|intercalez|supprimez|effacez|reportez)"
ARTICLE = r"(?U)(?:l'art\.?|art\.|l'article)\s*([A-ZÀ-Ýl][\w'’\- ]+?)(?=[,.(]|\s+(?:de|doit|qui|même|et)\b)"


def correction(c: Column, n_entries: Column) -> Column:
    """struct<action, article, old, new, auto> of an instruction with `n_entries` added lines."""
    part = lambda p, k: F.nullif(F.regexp_extract(c, p, k), F.lit(""))
    pair = lambda old, new, article=None: F.struct(old.alias("old"), new.alias("new"), (article if article is not None else F.lit(None).cast("string")).alias("article"))
    replaced = F.btrim(F.regexp_replace(F.substring_index(F.btrim(part(READ_FOR, 2), F.lit(" ,.")), ":", -1), r",\s*en supprimant.*$", ""), F.lit(" ,."))
    by_word = first_match(F.lower(c), ACTIONS)
    numbers = F.coalesce(F.when(c.rlike(NUMBER_NOT), pair(part(NUMBER_NOT, 2), part(NUMBER_NOT, 1))), F.when(c.rlike(ONLY_NUMBER), pair(part(ONLY_NUMBER, 2), part(ONLY_NUMBER, 1))))
    none = pair(F.lit(None).cast("string"), F.lit(None).cast("string"))
    read = ladder(
        [
            (c.rlike(NUMBER_FOR), F.struct(F.lit("renumber").alias("action"), pair(part(NUMBER_FOR, 2), part(NUMBER_FOR, 1)).alias("p"))),
            (c.rlike(FOR_NUMBER), F.struct(F.lit("renumber").alias("action"), pair(part(FOR_NUMBER, 1), part(FOR_NUMBER, 2)).alias("p"))),
            (c.rlike(ADD_NUMBER), F.struct(F.lit("renumber").alias("action"), pair(F.lit(None).cast("string"), part(ADD_NUMBER, 2), part(ADD_NUMBER, 1)).alias("p"))),
            (by_word == "renumber", F.struct(F.lit("renumber").alias("action"), F.coalesce(numbers, none).alias("p"))),
            (c.rlike(READ_FOR), F.struct(F.lit("replace").alias("action"), pair(F.btrim(part(READ_FOR, 1), F.lit(" ,")), replaced).alias("p"))),
        ],
        F.struct(F.coalesce(by_word, F.lit("other")).alias("action"), none.alias("p")),
    )

    def named(x: Column) -> Column:
        action = x["action"]
        page_word = part(rf"(?U)^P\.\s*\d{{3}}[.,]\s*([A-ZÀ-Ý][\w'’\-]+),\s", 1)
        after = part(rf"(?U)^{_WORD}.*?apr[eè]s\s+([A-ZÀ-Ý][\w'’\-]+)", 1)
        first = part(r"(?U)^([A-ZÀ-Ý][\w'’\-]+)", 1)
        article = F.coalesce(
            x["p"]["article"],
            F.when(~page_word.rlike(VERB_FIRST), page_word),
            F.when((action == "move") & after.isNotNull(), first),
            F.trim(part(ARTICLE, 1)),
            F.when(action == "delete", F.coalesce(part(rf"(?iU)(?:supprimez|effacez)\s*(?:l'art\.?\s*)?({_WORD})", 1), part(r"(?U)^([A-ZÀ-Ý][\w'’\-]+)\s*\(p\.\s*\d+\)\s*est à effacer", 1))),
            F.when(action.isin("add", "move"), part(rf"(?U)après (?:l'art\.?\s*|celui de\s+)?({_WORD})", 1)),
            F.when(action == "move", first),
        )
        new = F.when((action == "move") & after.isNotNull(), F.concat(F.lit("après "), after)).otherwise(x["p"]["new"])
        old = x["p"]["old"]
        auto = ladder(
            [
                (action == "renumber", new.isNotNull() & (old.isNotNull() | article.isNotNull())),
                (action == "replace", (old.isNotNull() & new.isNotNull()) | (n_entries > 0)),
                (action == "add", n_entries > 0),
                (action == "delete", article.isNotNull()),
            ],
            False,
        )
        return F.struct(action.alias("action"), article.alias("article"), old.alias("old"), new.alias("new"), auto.alias("auto"))

    return text.let(read, named)


# --- summer pastures (H17) ------------------------------------------------------------------------------------------

_COUNTED = r"(?i),?\s*(une|un|deux|trois|quatre|cinq|six|sept|huit)\s+g[iî]s[lt]es?\.?\s*$"
PASTURE_HEAD = r"^So(?:us|ub)z? la pr[eé]vost[eé] (?:de |d')\s*(.+?)\s*$"
_OPENING = r"^(?:Est la montagne ou chaulme appe\S+ communément|Sont les chaulmes de)\s+"


def pasture_ends(c: Column) -> Column:
    """Whether a line closes a pasture: by its count of gîtes, or, for a plain without one, by a comma."""
    return c.rlike(_COUNTED) | (folded(c).startswith("la plaine") & F.rtrim(c).endswith(","))


def pasture(c: Column, spellings: dict[str, str] | None = None) -> Column:
    """struct<name, also, gistes> of a pasture's joined lines; `spellings` puts printed names for misread ones."""
    joined = F.regexp_replace(c, _OPENING, "")
    word = F.lower(F.regexp_extract(joined, _COUNTED, 1))
    body = F.regexp_replace(joined, _COUNTED, "")
    parts = F.filter(F.transform(F.split(body, r",\s*|\s+et\s+(?=en allemand|ali[aà]s)"), lambda p: F.btrim(p, F.lit(" ,."))), lambda p: p != "")
    bare = F.transform(parts, lambda p: text.fix_name(F.regexp_replace(p, r"^(?:et\s+)?(?:en allemand|ali[aà]s)\s+", "")))
    put = (lambda n: F.coalesce(look_up(n, spellings), n)) if spellings else (lambda n: n)
    names = F.transform(bare, put)
    return F.struct(F.get(names, 0).alias("name"), F.slice(names, F.lit(2), F.greatest(F.size(names) - 1, F.lit(0))).alias("also"), look_up(word, NUMERALS).alias("gistes"))


# --- places and territories (B9, B10, B13, B14) ------------------------------------------------------------------------


def place_type(index_kind: Column, descriptors: Column) -> Column:
    """A settlement's type: what the index calls it, else what its entry says."""
    has = lambda *ks: F.arrays_overlap(descriptors, F.array(*map(F.lit, ks)))
    settled = has("village", "town")
    return F.coalesce(
        first_match(folded(F.coalesce(index_kind, F.lit(""))), KIND_TYPES),
        ladder([(has("town"), "town"), (has("small_town"), "small_town"), (has("castle") & ~settled, "castle"), (has("abbey") & ~settled, "abbey"), (has("priory") & ~settled, "priory"), (has("glassworks"), "glassworks")], "village"),
    )


def country_of(region: Column) -> Column:
    """The modern country of an index line's region, France where it says nothing."""
    german = region.isin("Pr.", "Bav.") | region.rlike("Oldenbo?urg")
    return ladder([(german, "DE"), (region == "Luxembourg", "LU")], "FR")


def unlocated_type(name: Column, index_kind: Column, kind: Column, series: Column) -> Column:
    """What an unlocated entry names, for a report."""
    k = folded(F.coalesce(index_kind, F.lit("")))
    tests = (
        folded(name).rlike(r"^(?:ban|san|sun)\b"),
        k.rlike(r"\b[lf]i?ef"),
        k.contains("gagna") | (kind == "grange"),
        k.contains("verrerie") | (kind == "glassworks"),
        k.contains("detruit") | (kind == "deserted_village"),
        series != "main",
    )
    return ladder(zip(tests, UNLOCATED), UNLOCATED[-1])


def inferred_section(section: Column, realm_holder: Column) -> Column:
    """The section of an entry without one: the duke's realms are domain, other holders' fiefs."""
    return F.when(F.coalesce(section, F.lit("other")) != "other", section).otherwise(ladder([(realm_holder == "duke", "domain"), (realm_holder.isNotNull(), "fief")], "other"))


def admin_level(kind: Column, parent_level: Column) -> Column:
    """The level of a division by its kind, never above its parent's."""
    return F.greatest(look_up(kind, ADMIN_LEVELS, 2), F.coalesce(parent_level + 1, F.lit(1))).cast("int")


def share_label(share: Column) -> Column:
    return F.coalesce(look_up(share, SHARES), share)


def index_identification(kind: Column, commune: Column, canton: Column, dept: Column) -> Column:
    """"hamlet, commune X, canton Y, Z" without what is missing."""
    said = lambda word, c: F.concat(F.lit(word), F.nullif(c, F.lit("")))
    return F.concat_ws(", ", F.nullif(kind, F.lit("")), said("commune ", commune), said("canton ", canton), F.nullif(dept, F.lit("")))


def capital(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 10_000))


def territory_names(kind: Column, seat: Column, fr: Column, de: Column, en: Column, seat_de: Column | None = None, seat_en: Column | None = None) -> Column:
    """struct<fr, de, en>: the names of a territory from its type's labels and its seat; French elides before a vowel, not before an h."""
    link = F.when(F.substring(folded(seat), 1, 1).rlike("[aeiouy]"), "d'").otherwise("de ")
    seat_de, seat_en = F.coalesce(seat_de, seat) if seat_de is not None else seat, F.coalesce(seat_en, seat) if seat_en is not None else seat
    bare = F.regexp_replace(de, r"\s*\(.*\)$", "")
    usual = F.struct(F.concat(capital(fr), F.lit(" "), link, seat).alias("fr"), F.concat(bare, F.lit(" "), seat_de).alias("de"), F.concat(capital(en), F.lit(" of "), seat_en).alias("en"))
    abbey = F.struct(F.concat(F.lit("Temporel de l'abbaye de "), seat).alias("fr"), F.concat(F.lit("Kirchengut der Abtei "), seat_de).alias("de"), F.concat(F.lit("Lands of the abbey of "), seat_en).alias("en"))
    return F.when(kind == "temporality", abbey).otherwise(usual)


def renamed_in(line: Column, old: Column, new: Column) -> Column:
    """A report's line with an id put for another where it stands by itself."""
    # a replacement text takes no special signs: ids are letters, digits and hyphens
    return F.regexp_replace(line, F.concat(F.lit(r"(?<![a-z0-9-])\Q"), old, F.lit(r"\E(?![a-z0-9-])")), new)


def bare_name(c: Column) -> Column:
    """A name without brackets and note calls."""
    return F.trim(F.regexp_replace(c, r"\s*\(.*?\)|[*\d]+$", ""))
