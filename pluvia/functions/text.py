"""Text rules as Column expressions and DataFrame operators: names, notices, mentions, crossings, TF-IDF."""

from __future__ import annotations

import difflib
import math
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.sources.rounds import settled, shuffles_removed

# Rules for notices in Spanish (lower case).
FUTURE_RESTORE = r"(?:ser[aá]n?|ser|quedar[aá]n?|estar[aá]n?|empezar[aá]n?\s+a\s+ser)\s+restablecid\w*|se\s+restablecer[aá]n?"
EVENT_RULES = (
    ("pipas", r"pipa"),
    ("emergencia", r"fuga|ruptura|emergencia|falla el[eé]ctrica|desabasto"),
    ("corte_programado", r"programad|suspensi[oó]n del servicio|corte del servicio"),
    ("restablecimiento", r"restablecid[oa]|se restableci[oó]|qued[oó]\s+restablecid|se normaliz[oó]|reanud[oó]|concluy\w+\s+(?:la\s+|los\s+|el\s+)?(?:reparaci|trabajo|maniobra)|ya cuenta con (?:el )?servicio"),
)
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
NUMBERS = {
    "una": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12,
    "dieciocho": 18, "veinticuatro": 24, "cuarenta y ocho": 48,
}
DURATION = (
    r"(?:de|por|durante|en|dura(?:r[aá]|ci[oó]n de)|no mayor a|estima(?:do|n)? en|aproximadamente)\s+(\d{1,3}|"
    + "|".join(sorted(NUMBERS, key=len, reverse=True))
    + r")\s*horas"
)
DATE = r"(\d{1,2})\s+de\s+(" + "|".join(MONTHS) + ")"
START_TIME = r"(?:a partir de las?|de las?|inicio a las?)\s*(\d{1,2})(?::(\d{2}))?\s*(am|pm|hrs|horas)?"
PLACE_MARKER = r"(COLONIAS?|COL|FRACCIONAMIENTOS?|FRACC|RESIDENCIAL|SECTOR|ASENTAMIENTO)\s*$"
STREET_MARKER = r"(CALLE|BULEVAR|BLVD|AVENIDA|AVE|CALZADA|CARRETERA|PERIFERICO|PROLONGACION|RETORNO|CALLEJON)\s*$"
INSTITUTIONAL = ("H AYUNTAMIENTO",)
STREET_TYPE = r"(?:calle|bulevar|blvr\.?|blvd\.?|avenida|av\.?|camino|carretera|periférico|prolongación|retorno|callejón)"
NAME = r"[\wáéíóúñÁÉÍÓÚÑ]+(?:[ \t]+[\wáéíóúñÁÉÍÓÚÑ]+){0,3}"
CROSSING = (
    rf"{STREET_TYPE}[ \t]+({NAME}(?:[ \t]+entre[ \t]+{NAME}[ \t]+y[ \t]+{NAME}|[ \t]+entre[ \t]+{NAME}|[ \t]+y[ \t]+(?:{STREET_TYPE}[ \t]+)?{NAME}))"
)
# how a street type begins: most places of a text are passed by here, before the alternatives are tried
TYPE_AHEAD = "(?-iuU:(?=[abcprABCPR])(?=[aA][vV]|[bB][lLuU]|[cC][aA][lLmMrR]|[pP](?:[eE][rR]|[rR][oO])|[rR][eE][tT]))"
CROSSING_FORMS = (r"(.+?) entre (.+?) y (.+)$", r"(.+?) entre (.+)$", r"(.+?) y (.+)$")
ARTICLES = ("DE LOS ", "DE LAS ", "DE LA ", "DEL ", "LOS ", "LAS ", "LA ", "EL ")
TYPE_PREFIX = r"^(?:CALLE|BULEVAR|BLVR|BLVD|AVENIDA|AVE|AV|CAMINO|CARRETERA|PERIFERICO|PROLONGACION|RETORNO|CALLEJON)\s+"
STREET_NUMBERS = {"UNO": "1", "DOS": "2", "TRES": "3", "CUATRO": "4", "CINCO": "5", "SEIS": "6", "SIETE": "7", "OCHO": "8", "NUEVE": "9", "DIEZ": "10"}


#: Most names of a catalog that go to the tasks as such.
HELD_NAMES = 2000


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and the plain letters that remain when their marks are dropped."""
    pairs = []
    for c in map(chr, range(0xC0, 0x250)):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != c:
            pairs.append((c, plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _plain_letters()
_MARKS = "".join(map(chr, range(0x300, 0x370)))


def strip_accents(col: Column) -> Column:
    """Latin letters without their marks; loose combining marks go."""
    return F.translate(col, _ACCENTED + _MARKS, _PLAIN)


def normalize_name(col: Column) -> Column:
    """Upper-case letters, digits and single spaces only; null becomes empty. Latin scripts, no Python."""
    return F.trim(F.regexp_replace(F.upper(strip_accents(F.coalesce(col, F.lit("")))), "[^A-Z0-9]+", " "))


def normalize_any_script(col: Column) -> Column:
    """normalize_name for text outside the Latin blocks, by full compatibility decomposition in Arrow batches."""
    return F.pandas_udf(_normalize, "string")(col)


def _normalize(names: pd.Series) -> pd.Series:
    plain = names.fillna("").map(lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))
    return plain.str.upper().str.replace(r"[^A-Z0-9 ]", " ", regex=True).str.split().str.join(" ")


def normalize_settlement(col: Column) -> Column:
    """normalize_name without a leading settlement type; empty becomes null."""
    plain = strip_accents(F.upper(F.trim(col)))
    bare = F.regexp_replace(plain, r"^(COLONIA|COL\.?|FRACCIONAMIENTO|FRACC\.?)\s+", "")
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(bare, r"[^A-Z0-9\s]", " "), r"\s+", " ")), F.lit(""))


def classify_rules(col: Column, erase: str = FUTURE_RESTORE, rules=EVENT_RULES, default: str = "otro") -> Column:
    """Label of the last rule that matches once `erase` is taken out; null text gets the default."""
    text = F.regexp_replace(F.coalesce(col, F.lit("")), erase, " ")
    case = None
    for label, pattern in reversed(rules):
        case = (F if case is None else case).when(text.rlike(pattern), label)
    return case.otherwise(default)


def parse_duration_hours(col: Column) -> Column:
    """Hours of the first duration that "las" doesn't precede (a phone line's "las 24 horas")."""
    value = F.nullif(F.regexp_extract(F.coalesce(col, F.lit("")), r"(?<!las)(?<!las\s)" + DURATION, 1), F.lit(""))
    words = F.create_map(*[F.lit(x) for k, v in NUMBERS.items() for x in (k, float(v))])
    return F.coalesce(value.try_cast("double"), F.try_element_at(words, value))


def parse_start(col: Column, published: Column, max_days: int = 30) -> Column:
    """Announced start: day and month with the year that lies closest to the publication (the earlier one on ties),
    null beyond max_days, for impossible dates and hours over 23."""
    text = F.coalesce(col, F.lit(""))
    found = lambda pattern, i: F.regexp_extract(text, pattern, i)
    number = lambda c: F.nullif(c, F.lit("")).cast("int")
    read = F.struct(
        number(found(DATE, 1)).alias("day"), F.array_position(F.array(*[F.lit(m) for m in MONTHS]), found(DATE, 2)).cast("int").alias("month"),
        F.coalesce(number(found(START_TIME, 1)), F.lit(0)).alias("hour"), F.coalesce(number(found(START_TIME, 2)), F.lit(0)).alias("minute"),
        (found(START_TIME, 3) == "pm").alias("pm"), published.cast("timestamp_ntz").alias("at"),
    )

    def nearest(e: Column) -> Column:
        hour = F.when(e["pm"] & (e["hour"] < 12), e["hour"] + 12).otherwise(e["hour"])

        def candidate(shift: int) -> Column:
            written = F.format_string("%04d-%02d-%02d %02d:%02d:00", F.year(e["at"]) + shift, e["month"], e["day"], hour, e["minute"])
            stamp = F.when(e["day"].isNotNull() & (e["month"] > 0) & (hour < 24) & (e["minute"] < 60), written.try_cast("timestamp_ntz"))
            return F.struct(F.abs(F.timestamp_diff("SECOND", e["at"], stamp)).alias("far"), stamp.alias("at"))

        return F.array_min(F.filter(F.array(*[candidate(k) for k in (-1, 0, 1)]), lambda c: c["at"].isNotNull()))

    # arrays of one: what stands in them is worked out once a row, though it is used several times
    best = F.transform(F.array(read), nearest)
    return F.transform(best, lambda c: F.when(c["far"] <= max_days * 86400, c["at"]))[0]


def local_time_features(df: DataFrame, col: str, tz: str = "America/Hermosillo") -> DataFrame:
    """Adds published_at (local, without zone), year, month, iso_week, day_of_week (Monday 0), hour_of_day."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(col).cast("timestamp_ntz"))
    return (
        df.withColumn("published_at", local).withColumn("year", F.year("published_at")).withColumn("month", F.month("published_at"))
        .withColumn("iso_week", F.weekofyear("published_at")).withColumn("day_of_week", F.weekday("published_at")).withColumn("hour_of_day", F.hour("published_at"))
    )


def dealt(docs: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """The key and the fields, dealt evenly: files may hold few row groups, and reading a text takes longer than sending it."""
    return docs.select(key, *fields).repartition(key, *fields)


def dictionary_mentions(docs: DataFrame, key: str, fields: dict[str, str], catalog: DataFrame, name: str, id_col: str, min_len: int = 6, stop=INSTITUTIONAL, lookback: int = 14, prefer: str = "first") -> DataFrame:
    """Catalog names as whole words in text fields (column -> label): one row per document and name.

    A catalog of up to HELD_NAMES names is looked up in each text where it lies; of a larger one word n-grams are joined. Overlaps are settled per field from left
    to right; of names that start at one word the alphabetically first wins (prefer='longest': the longest). A name
    goes if a street word ends the `lookback` characters before it. match_method tells whether a settlement word did.
    A document named in two fields counts once, source_field 'ambos'. Rows that share a key are read each on its own and
    counted together; a null key has no mentions.
    """
    names = catalog.select(F.col(name).alias("name"), F.col(id_col).alias("_id")).where((F.length("name") >= min_len) & ~F.col("name").isin(*stop))
    names = names.groupBy("name").agg(F.min("_id").alias(id_col)).withColumn("words", F.split("name", " "))
    held = [r[0] for r in names.select("name").limit(HELD_NAMES + 1).collect()]
    docs = dealt(docs.where(F.col(key).isNotNull()), key, fields)
    long = F.explode(F.array(*[F.struct(F.lit(label).alias("field"), normalize_name(F.col(c)).alias("text")) for c, label in fields.items()]))
    texts = docs.select(F.col(key), long.alias("_f")).select(key, "_f.*").where("text <> ''")
    order = "n" if prefer == "first" else "-n"
    # `lookback` characters take no more words than that
    before = f"IF(s.pos = 0, '', right(concat(array_join(slice(tokens, greatest(s.pos - {lookback - 1}, 1), least(s.pos, {lookback})), ' '), ' '), {lookback}))"
    hit = f"n -> struct(s.pos AS pos, {order} AS o, n AS n, array_join(slice(tokens, s.pos + 1, n), ' ') AS name, {before} AS before)"
    grams = f"flatten(transform(starts, s -> transform(sequence(1, least(s.longest, size(tokens) - s.pos)), {hit})))"
    if len(held) <= HELD_NAMES:
        longest = max((len(n.split(" ")) for n in held), default=0)
        start = lambda w, i: F.when(w.isin([n.split(" ")[0] for n in held]), F.struct(i.alias("pos"), F.lit(longest).alias("longest")))
        here = [key, "field"]
        # words and starts pass through explode, so that a filter or a reader further on doesn't work them out again
        words = texts.select(*here, F.explode(F.array(F.split("text", " "))).alias("tokens"))
        starts = words.select("*", F.explode(F.array(F.array_compact(F.transform("tokens", start)))).alias("starts")).where(F.size("starts") > 0)
        per = starts.withColumn("grams", F.expr(grams)).select(*here, F.sort_array(F.filter("grams", lambda g: g["name"].isin(held))).alias("all"))
    else:
        heads = names.groupBy(F.col("words")[0].alias("head")).agg(F.max(F.size("words")).alias("longest"))
        texts = texts.withColumn("th", F.xxhash64("text"))
        # a name can begin only where its first word stands; these places go back to their text together, so no text is copied per place
        words = texts.select(key, "field", "th", F.posexplode(F.split("text", " ")).alias("pos", "head"))
        here = [key, "field", "th"]
        starts = words.join(heads, "head").groupBy(*here).agg(F.collect_set(F.struct("pos", "longest")).alias("starts"))
        texts = texts.withColumn("tokens", F.split("text", " ")).drop("text")
        hits = starts.join(texts, here).select(*here, F.inline(F.expr(grams))).join(names.select("name"), "name")
        per = hits.groupBy(*here).agg(F.sort_array(F.collect_list(F.struct("pos", "o", "n", "name", "before"))).alias("all"))
    fold = """aggregate(all, struct(0 AS end, cast(array() AS array<struct<name:string,before:string>>) AS kept),
        (acc, h) -> IF(h.pos >= acc.end, struct(h.pos + h.n AS end, concat(acc.kept, array(struct(h.name AS name, h.before AS before))) AS kept), acc)).kept"""
    placed = per.select(*here, F.explode(F.expr(fold)).alias("_k")).select(*here, "_k.name", "_k.before")
    free = placed.where(~F.col("before").rlike(STREET_MARKER)).withColumn("marked", F.col("before").rlike(PLACE_MARKER))
    both = free.groupBy(key, "name").agg(F.max("marked").alias("marked"), F.sort_array(F.collect_set("field")).alias("seen"))
    source = F.when(F.size("seen") > 1, "ambos").otherwise(F.col("seen")[0])
    method = F.when(F.col("marked"), "colonia_con_marcador").otherwise("colonia_en_catalogo")
    return both.join(names.select("name", id_col), "name").select(key, F.lit("colonia").alias("location_type"), F.col("name").alias("raw_text"), id_col, source.alias("source_field"), method.alias("match_method"))


def extract_crossings(docs: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """Street-crossing phrases per document; one row per phrase, the first field that has it."""
    parts = F.array(*[F.struct(F.lit(i).alias("o"), F.lit(label).alias("source_field"), F.coalesce(F.col(c), F.lit("")).alias("text")) for i, (c, label) in enumerate(fields.items())])
    rows = dealt(docs, key, fields).select(key, F.explode(parts).alias("p")).select(key, "p.*")
    found = rows.select(key, "o", "source_field", F.explode(F.regexp_extract_all("text", F.lit("(?iuU)" + TYPE_AHEAD + CROSSING), F.lit(1))).alias("e"))
    first = found.groupBy(key, F.trim("e").alias("expression")).agg(F.min(F.struct("o", "source_field")).alias("m"))
    return first.select(key, "expression", F.col("m.source_field").alias("source_field"))


def parse_crossing(col: Column) -> Column:
    """[main street, crossing streets...] by the first form that fits, else null."""
    case = None
    for form, n in zip(CROSSING_FORMS, (3, 2, 2), strict=True):
        pattern = "(?iu)^" + form
        case = (F if case is None else case).when(col.rlike(pattern), F.array(*[F.regexp_extract(col, pattern, i + 1) for i in range(n)]))
    return case


def _ratio(a: str | Column, b: str | Column) -> Column:
    return F.pandas_udf(_ratios, "double")(a, b)


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _bigrams(c: str) -> Column:
    """Pairs of letters that follow each other, each with how often it stood before: a set, where the text has a bag."""
    pairs = f"IF(length({c}) < 2, cast(array() AS array<string>), transform(sequence(1, length({c}) - 1), i -> substring({c}, i, 2)))"
    return F.expr(f"transform({pairs}, (x, i) -> concat(x, size(filter(slice({pairs}, 1, i), y -> y = x))))")


def _shared_bigrams(a: Column, b: Column, cutoff: float, mode: str) -> Column:
    """How many bigrams names of a and b letters share at least, if their similarity reaches the cutoff.

    Matching blocks hold m = cutoff (a + b) / 2 letters at least; there are at most a + b - 2 m letters outside, one of which stands between
    any two blocks, and a block of n letters has n - 1 bigrams. An edit undoes two bigrams at most."""
    if mode == "levenshtein":
        longest = F.greatest(a, b)
        return longest - 1 - 2 * F.floor((1 - cutoff) * longest + 1e-9)
    return 3 * F.ceil(cutoff * (a + b) / 2 - 1e-9) - (a + b) - 1


def similar_candidates(names: DataFrame, name: str, catalog: DataFrame, other: str, cutoff: float, mode: str = "ratio") -> DataFrame:
    """(name, other): distinct pairs that may reach the cutoff, by an inverted index of bigrams.

    Bigrams are put in one order, the rarest first. Of n bigrams of which t must be shared, one of the first n - t + 1 must be, on either side; t
    follows from the two lengths, so names meet by (both lengths, bigram). Lengths for which no bigram need be shared meet as such.
    """
    low, high = (cutoff, 1 / cutoff) if mode == "levenshtein" else (cutoff / (2 - cutoff), (2 - cutoff) / cutoff)
    # written once: both sides are read for the order of bigrams and for the keys
    left, right = settled(names.select(name).distinct().where(F.length(name) > 0)), settled(catalog.select(other).distinct().where(F.length(other) > 0))
    bags = [df.select(c, F.explode(_bigrams(f"`{c}`")).alias("_sc_t")) for df, c in ((left, name), (right, other))]
    often = bags[0].select("_sc_t").unionByName(bags[1].select("_sc_t")).groupBy("_sc_t").agg(F.count("*").alias("_sc_n"))

    def prefixes(df: DataFrame, c: str, bag: DataFrame, first: bool) -> DataFrame:
        ordered = bag.join(often, "_sc_t").groupBy(c).agg(F.sort_array(F.collect_list(F.struct("_sc_n", "_sc_t"))).alias("_sc_s"))
        own = F.length(c)
        span = F.sequence(F.ceil(own * low - 1e-9).cast("int"), F.floor(own * high + 1e-9).cast("int"))
        rows = df.join(ordered, c, "left").select(c, "_sc_s", own.alias("_sc_own"), F.explode(span).alias("_sc_far"))
        a, b = ("_sc_own", "_sc_far") if first else ("_sc_far", "_sc_own")
        t = _shared_bigrams(F.col(a), F.col(b), cutoff, mode)
        held = F.coalesce(F.size("_sc_s"), F.lit(0)) - t + 1
        keys = F.when(t <= 0, F.array(F.lit(""))).when((held > 0) & F.col("_sc_s").isNotNull(), F.transform(F.slice("_sc_s", F.lit(1), F.greatest(held, F.lit(0)).cast("int")), lambda x: x["_sc_t"]))
        return rows.select(c, F.col(a).alias("_sc_a"), F.col(b).alias("_sc_b"), F.explode(keys).alias("_sc_t"))

    return prefixes(left, name, bags[0], True).join(prefixes(right, other, bags[1], False), ["_sc_a", "_sc_b", "_sc_t"]).select(name, other).distinct()


def similar_pairs(names: DataFrame, name: str, catalog: DataFrame, other: str, cutoff: float, mode: str = "ratio", catalog_first: bool = False) -> DataFrame:
    """(name, other, score) of all distinct pairs with similarity at least cutoff.

    Pairs come from an index of bigrams (`similar_candidates`), which loses none; those whose letter counts can't reach the cutoff are left
    out before any score is taken. mode 'ratio' is matching blocks, 'levenshtein' is 1 - distance / longer length. Matching blocks depend on
    which side comes first: the name, or with `catalog_first` the catalog's. Null and empty names match nothing.
    """
    pairs = similar_candidates(names, name, catalog, other, cutoff, mode)
    if mode == "levenshtein":
        score = 1 - F.levenshtein(name, other) / F.greatest(F.length(name), F.length(other))
        return pairs.withColumn("score", score).where(F.col("score") >= cutoff).select(name, other, "score")
    shared = F.expr(f"aggregate(array_distinct(split({name}, '')), 0, (n, c) -> n + least(length({name}) - length(replace({name}, c, '')), length({other}) - length(replace({other}, c, ''))))")
    near = pairs.where(2 * shared >= cutoff * (F.length(name) + F.length(other)) - 1e-9)
    score = _ratio(other, name) if catalog_first else _ratio(name, other)
    return near.withColumn("score", score).where(F.col("score") >= cutoff).select(name, other, "score")


def street_candidates(names: DataFrame, name: str, streets: DataFrame, street: str, cutoff: float = 0.85, fuzzy: bool = True) -> DataFrame:
    """(name, street): streets that contain the longest word prefix of the name that any street contains.

    Prefixes are also tried without a leading article and, as a whole, with number words written as digits. Names without any
    such street get the closest one at or above the cutoff, the last by name on ties.
    """
    keyed = names.select(name).distinct().withColumn("_key", F.regexp_replace(normalize_name(F.col(name)), TYPE_PREFIX, ""))
    cuts = keyed.where("_key <> ''").withColumn("_w", F.split("_key", " ")).select(name, "_key", F.explode(F.expr("transform(sequence(1, size(_w)), n -> struct(n AS cut, array_join(slice(_w, 1, n), ' ') AS gram))")).alias("c"))
    digits = F.create_map(*[F.lit(x) for kv in STREET_NUMBERS.items() for x in kv])
    gram = F.coalesce(F.try_element_at(digits, F.col("c.gram")), F.col("c.gram"))
    bare = [F.when(gram.startswith(a), F.substring(gram, len(a) + 1, 1000)) for a in ARTICLES]
    variants = F.array_distinct(F.array_compact(F.array(gram, *bare)))
    tried = cuts.select(name, F.col("c.cut").alias("cut"), F.explode(variants).alias("gram")).where("gram <> ''")
    index = streets.select(street).distinct().withColumn("_w", F.split(street, " ")).select(street, F.explode(F.expr("flatten(transform(sequence(1, size(_w)), i -> transform(sequence(i, size(_w)), j -> array_join(slice(_w, i, j - i + 1), ' '))))")).alias("gram")).distinct()
    hits = settled(tried.join(index, "gram").select(name, "cut", street).distinct())
    best = hits.groupBy(name).agg(F.max("cut").alias("cut"))
    exact = hits.join(best, [name, "cut"]).select(name, street)
    if not fuzzy:
        return exact
    left = settled(keyed.join(best, name, "left_anti").where("_key <> ''"))
    if left.isEmpty():
        return exact
    near = similar_pairs(left, "_key", streets, street, cutoff, catalog_first=True)
    top = near.groupBy("_key").agg(F.max(F.struct("score", F.col(street).alias("v"))).alias("b"))
    return exact.unionByName(left.join(top, "_key").select(name, F.col("b.v").alias(street)))


#: Names and candidates that one task compares at a time.
BLOCK_NAMES, BLOCK_OTHERS = 1024, 4096


def _letters(texts: list[str], alphabet: list[str], kind: str) -> np.ndarray:
    return np.array([[x.count(c) for x in texts] for c in alphabet], dtype=kind).reshape(len(alphabet), len(texts))


def _best_three(bounds: np.ndarray, name: str, others: list[str], whole: bool, min_ratio: float, margin: float) -> list[tuple[float, str]]:
    """The best three of the others by score, then by name. If these are all others of the name, it may be less: none where it is refused
    whichever of them is left out, two where no further one comes within the margin."""
    top = bounds.max() if whole else 1.0
    if whole and top < min_ratio:
        return []
    some = min(16, len(others))
    order = np.argpartition(-bounds, some - 1)[:some]
    order = order[np.argsort(-bounds[order], kind="stable")]
    best: list[tuple[float, str]] = []
    for at in range(len(others)):
        if at == some:  # seldom: all the others in order
            order = np.concatenate([order, np.setdiff1d(np.arange(len(others)), order)])
            order[some:] = order[some:][np.argsort(-bounds[order[some:]], kind="stable")]
        j = order[at]
        if len(best) == 3 and bounds[j] < -best[2][0]:
            break
        if whole and best and -best[0][0] < min_ratio and bounds[j] < min_ratio:
            return []
        if whole and len(best) > 1 and -best[1][0] > bounds[j] and -best[1][0] - bounds[j] >= margin:
            break
        best = sorted([*best, (-difflib.SequenceMatcher(None, name, others[j]).ratio(), others[j])])[:3]
        if len(best) == 3 and top + best[2][0] < margin:
            return []
    return [(-s, o) for s, o in best]


def _closest(min_ratio: float, margin: float):
    """Best scores of each name among the others of its row. No score passes the share of common letters, so few are worked out."""

    def run(batches):
        for batch in batches:
            for c1, c2, names, others, whole in zip(batch["_c1"], batch["_c2"], batch["_names"], batch["_others"], batch["_whole"], strict=True):
                names, others, out = list(names), list(others), []
                kind = "uint8" if max(map(len, names)) < 256 or max(map(len, others)) < 256 else "uint32"
                cap = 255 if kind == "uint8" else None
                alphabet = sorted(set("".join(names)) & set("".join(others)))
                a, b = (np.minimum(_letters(x, alphabet, "uint32"), cap or 2**32 - 1).astype(kind) for x in (names, others))
                la, lb = np.array([len(x) for x in names]), np.array([len(x) for x in others])
                for at in range(0, len(names), 128):
                    part = slice(at, at + 128)
                    shared = np.zeros((len(names[part]), len(others)), dtype=kind)
                    for i in range(len(alphabet)):
                        shared += np.minimum(a[i, part, None], b[i, None, :])
                    total = la[part, None] + lb[None, :]
                    bounds = np.where(total > 0, 2.0 * shared / np.maximum(total, 1), 1.0)
                    for name, row in zip(names[part], bounds, strict=True):
                        out += [(c1, c2, name, o, s) for s, o in _best_three(row, name, others, whole, min_ratio, margin)]
                yield pd.DataFrame(out, columns=["_c1", "_c2", "_n", "_o", "score"]).astype({"_c1": "int64", "_c2": "int64", "score": "float64"})

    return run


def _blocks(df: DataFrame, col: str, rows: int, out: str) -> DataFrame:
    """_c1, _c2, out: the values of a class in lists of about `rows` at most; _many: how many lists it has."""
    many = df.groupBy("_c1", "_c2").agg(F.ceil(F.count("*") / rows).alias("_many"))
    dealt = df.join(_held(settled(many)), ["_c1", "_c2"]).withColumn("_b", F.pmod(F.xxhash64(col), F.col("_many")))
    return dealt.groupBy("_c1", "_c2", "_b", "_many").agg(F.collect_list(col).alias(out)).drop("_b")


def similar_adjacent(unknown: DataFrame, name: str, known: str, touching: DataFrame, street: str, other: str, min_ratio: float = 0.6, margin: float = 0.1) -> DataFrame:
    """Resolves an unknown name among the streets that touch a known one (touching: street, other). Refused if the
    best ratio is under min_ratio or the runner-up is within the margin.

    Streets that touch the same streets and each other are one class (by two 64-bit hashes of what they touch and themselves). A name is
    scored once for a class, against all that its streets touch; the known street itself is left out of the best three afterwards.
    """
    asked = settled(unknown.select(F.col(name).alias("_name"), F.col(known).alias("_k")).where("_k is not null"))
    texts = asked.select("_name").distinct().withColumn("_n", normalize_name(F.col("_name")))
    texts = settled(texts)
    links = settled(touching.select(F.col(street).alias("_k"), F.col(other).alias("_o")).where("_k is not null and _o is not null").distinct())
    itself = F.coalesce(F.max(F.col("_o") == F.col("_k")), F.lit(False))
    sums = links.groupBy("_k").agg(itself.alias("_self"), *(F.bit_xor(F.xxhash64(F.lit(i), "_o")).alias(f"_c{i}") for i in (1, 2)))
    classed = settled(sums.select("_k", "_self", *(F.when(F.col("_self"), F.col(f"_c{i}")).otherwise(F.col(f"_c{i}").bitwiseXOR(F.xxhash64(F.lit(i), "_k"))).alias(f"_c{i}") for i in (1, 2))))
    first = settled(classed.groupBy("_c1", "_c2").agg(F.min("_k").alias("_k")))
    others = links.join(_held(first), "_k").select("_c1", "_c2", "_o").union(first.select("_c1", "_c2", "_k")).distinct()
    asked = settled(asked.join(_held(texts), asked["_name"].eqNullSafe(texts["_name"])).select(asked["_name"], "_k", "_n").join(_held(classed), "_k"))
    names = asked.select("_c1", "_c2", "_n").distinct()
    left, right = _blocks(settled(names), "_n", BLOCK_NAMES, "_names").drop("_many"), _blocks(settled(others), "_o", BLOCK_OTHERS, "_others")
    work = settled(left.join(right, ["_c1", "_c2"]).select("_c1", "_c2", "_names", "_others", (F.col("_many") == 1).alias("_whole")))
    # few lists a partition, so that a batch stays small
    dealt = work.repartition(max(1, math.ceil(work.count() / 16)))
    scored = settled(dealt.mapInPandas(_closest(min_ratio, margin), "_c1 long, _c2 long, _n string, _o string, score double"))
    pairs = asked.join(scored, ["_c1", "_c2", "_n"]).where((F.col("_o") != F.col("_k")) | F.col("_self")).select("_name", "_k", "_o", "score").distinct()
    w = Window.partitionBy("_name", "_k").orderBy(F.desc("score"), "_o")
    ranked = pairs.withColumn("r", F.row_number().over(w)).withColumn("next", F.lead("score").over(w)).where("r = 1")
    ok = (F.col("score") >= min_ratio) & (F.col("next").isNull() | (F.col("score") - F.col("next") >= margin))
    return ranked.where(ok).select(F.col("_name").alias(name), F.col("_k").alias(known), F.col("_o").alias(other), "score")


def split_bullets(df: DataFrame, col: str) -> DataFrame:
    """One row per line of text: bullets stripped, empty lines, headers (ending in a colon) and web lines dropped."""
    lines = F.transform(F.split(F.coalesce(F.col(col), F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"^[ •·▪\-\t\r]+|[ •·▪\-\t\r]+$", ""))
    kept = F.filter(lines, lambda x: (x != "") & ~x.endswith(":") & ~x.contains("www."))
    return df.withColumn("line", F.explode(kept))


def keyword_rate(df: DataFrame, text: str, pattern: str, by: Column, name: str = "period") -> DataFrame:
    return df.where(F.col(text).isNotNull()).groupBy(by.alias(name)).agg(F.count("*").alias("n"), (F.avg(F.col(text).rlike(pattern).cast("double")) * 100).alias("percent"))


def text_length_features(df: DataFrame, col: str) -> DataFrame:
    words = F.when(F.trim(col) == "", 0).otherwise(F.size(F.split(F.trim(F.regexp_replace(col, r"\s+", " ")), " ")))
    return df.withColumn("n_chars_text", F.length(col)).withColumn("n_words", F.coalesce(words, F.lit(0)))


#: The most bytes of text whose terms are counted at once.
LOT_BYTES = 8_000_000


def _terms(table: pa.Table, key: str, bigrams: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Callable]:
    """Key (its place among the lot's), term (its place among codes) and how often, for each term of a document; codes, in order
    of the words, and what names them."""
    tokens = pa.concat_arrays(table["t"].chunks)
    found = tokens.flatten().dictionary_encode()
    order = pc.sort_indices(found.dictionary)
    words, many = found.dictionary.take(order), max(1, len(order))
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    word, row = rank[found.indices.to_numpy()], np.repeat(np.arange(len(tokens)), tokens.value_lengths().to_numpy())
    if bigrams:
        pair = np.flatnonzero(row[1:] == row[:-1])
        word, row = np.concatenate([word, many * (word[pair] + 1) + word[pair + 1]]), np.concatenate([row, row[pair]])
    at, met = pd.factorize(word)
    codes = np.sort(met)
    term = np.searchsorted(codes, met)[at]
    del word, at, met  # numbers of each word of a lot take most of a worker's memory
    # a document may come in several rows
    doc = pa.concat_arrays(table[key].chunks).dictionary_encode(null_encoding="encode").indices.to_numpy()[row].astype(np.int64)
    del row
    doc *= max(1, len(codes))
    doc += term
    cells, times = np.unique(doc, return_counts=True)

    def names(codes: np.ndarray) -> pa.Array:
        first = np.searchsorted(codes, many)
        of = lambda at: words.take(pa.array(at))
        return pa.concat_arrays([of(codes[:first]), pc.binary_join_element_wise(of(codes[first:] // many - 1), of(codes[first:] % many), " ")])

    return *np.divmod(cells, max(1, len(codes))), times, codes, names


def tfidf(docs: DataFrame, key: str, text: str, min_df: int = 5, max_df: float = 0.5, bigrams: bool = True, pattern: str = r"[a-z]{2,}") -> DataFrame:
    """(key, term, weight): sublinear TF, smoothed IDF, unit L2 norm per document; terms in at least min_df documents
    and at most a share max_df of them.

    Documents are dealt to lots by their key. A lot sends each of its terms once, with the number of its documents that have it, and gets back
    those that are kept, so neither the terms of each document nor the vocabulary are exchanged or held whole.
    """
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    lots = math.ceil((size or 0) / max(1, min(LOT_BYTES, (size or 0) // (8 * docs.sparkSession.sparkContext.defaultParallelism) + 250_000)))
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({pattern})"), F.lit(1))
    dealt = docs.select(key, text, F.pmod(F.xxhash64(key), F.lit(max(1, lots))).cast("int").alias("_lot")).repartition("_lot").select("_lot", key, tokens.alias("t"))
    kind = docs.select(key).schema[0].dataType.simpleString()

    def sent(table: pa.Table) -> pa.Table:
        _, term, _, codes, names = _terms(table, key, bigrams)
        lot = np.full(len(codes), table["_lot"][0].as_py(), np.int32)
        return pa.table({"_lot": lot, "term": names(codes), "n": np.bincount(term, minlength=len(codes)).astype(np.int32)})

    def weighed(texts: pa.Table, kept: pa.Table) -> pa.Table:
        if not texts.num_rows or not kept.num_rows:
            return pa.table({key: texts[key].slice(0, 0), "term": pa.array([], pa.string()), "weight": pa.array([], pa.float64())})
        doc, term, times, codes, names = _terms(texts, key, bigrams)
        # the kept term of each code, or -1
        place = pc.index_in(names(codes), kept["term"].combine_chunks()).fill_null(-1).to_numpy()[term]
        doc, place, times = doc[place >= 0], place[place >= 0], times[place >= 0]
        w = (1 + np.log(times)) * (np.log((1 + n) / (1 + kept["df"].to_numpy()[place])) + 1)
        norm = np.sqrt(np.bincount(doc, w * w))
        keys = pa.concat_arrays(texts[key].chunks).dictionary_encode(null_encoding="encode").dictionary
        return pa.table({key: keys.take(pa.array(doc)), "term": kept["term"].take(pa.array(place)), "weight": w / norm[doc]})

    found = dealt.groupBy("_lot").applyInArrow(sent, "_lot int, term string, n int").withColumn("df", F.sum("n").over(Window.partitionBy("term")))
    with shuffles_removed(docs.sparkSession):
        kept = settled(found.where((F.col("df") >= min_df) & (F.col("df") <= max_df * F.lit(n))).select("_lot", "term", "df"))
    return dealt.groupBy("_lot").cogroup(kept.groupBy("_lot")).applyInArrow(weighed, f"`{key}` {kind}, term string, weight double")


#: The most terms or documents whose numbers are broadcast to where the texts lie; more are joined by an exchange.
HELD_ROWS = 1_000_000


def _held(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= HELD_ROWS else df


def truncated_svd(entries: DataFrame, key: str, term: str, weight: str, k: int) -> DataFrame:
    """(key, component, value): the first k left components of the sparse matrix, sign fixed so that each component's
    largest value is positive; components beyond the matrix's rank are left out. `key` must be unique; the rows are numbered in its order."""
    from pluvia.operators.lanczos import left_components
    from pluvia.operators.ranks import numbered

    entries = entries.where(F.col(key).isNotNull())
    kind = dict(entries.dtypes)[key]
    spark = entries.sparkSession
    with shuffles_removed(spark):
        rows = settled(numbered(settled(entries.groupBy(key).agg(F.count("*").alias("_n"))), [key], "_i"))
    n, size = rows.agg(F.count("*"), F.sum("_n")).first()
    if not n:
        return spark.createDataFrame([], f"{key} {kind}, component int, value double")
    cells = entries.join(_held(rows.select(key, "_i")), key)
    parts, _ = left_components(cells, term, "_i", weight, n, size, k)
    blocks = spark.createDataFrame(parts.map(lambda x: (x[0], x[1].shape[1], x[1].tobytes())), "first long, width int, x binary")

    def by_row(batches):
        for batch in batches:
            for first, width, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                many = len(x) // 8 // width if width else 0
                flat = pa.ListArray.from_arrays(pa.array(np.arange(many + 1, dtype=np.int32) * width), pa.array(np.frombuffer(x)))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + many)), flat], ["_i", "x"])

    found = blocks.mapInArrow(by_row, "_i long, x array<double>").join(_held(rows.select(key, "_i")), "_i")
    return found.select(key, F.posexplode("x").alias("component", "value"))
