"""One consistent form for text that looks the same but is written with other characters.

Texts that consist of ordinary characters only are already in that form and are let through; a regular expression
built from the tables below finds the others. Those are moved once, as whole texts, to the partition of their row.
There they are exploded to positioned code points, broadcast-joined with the decomposition and look-alike table (some
8,000 rows from the Unicode character database and the fixed look-alikes, a size that doesn't depend on the data),
judged word by word, and rebuilt. Texts with combining marks or conjoining letters are decomposed in full, one row a
part; marks are ordered by combining class, and starters and marks recomposed by joins with the table of canonical
pairs, one for each level of composition. Hangul syllables, in both tables, come from their arithmetic. Explode and
broadcast join keep the partitioning, so every later step finds its rows in place and nothing is shuffled again.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import col, width

# Letters of other scripts and phonetic letters, each with its plain Latin look-alike.
LATIN_LOOKALIKES = (
    "аa еe оo рp сc уy хx ѕs іi јj һh ӏl ԁd ԛq ԝw ԍg "
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ӀI ԚQ ԜW "
    "ɡg ɑa ɩi ıi ᴄc ᴏo ꜱs ᴜu ᴠv ᴡw ᴢz ѡw "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX νv οo ιi κk ρp υu αa γy "
    "օo սu հh ոn ցg զq ՏS ՕO "
    "ᎪA ᏴB ᏟC ᎠD ᎬE ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᏒR ᏚS ᎢT ᏙV ᎳW ᏃZ "
    "ꓮA ꓐB ꓚC ꓓD ꓰE ꓝF ꓖG ꓧH ꓲI ꓙJ ꓗK ꓡL ꓟM ꓠN ꓳO ꓑP ꓣR ꓢS ꓔT ꓴU ꓦV ꓪW ꓫX ꓬY ꓜZ"
)
# Letters of other scripts, each with its Cyrillic look-alike, for rows whose own script that is.
CYRILLIC_LOOKALIKES = (
    "aа eе oо pр cс yу xх AА BВ EЕ KК MМ HН OО PР CС TТ YУ XХ "
    "ɵө ƟӨ ɑа ΑА ΒВ ΕЕ ΗН ΚК ΜМ ΟО ΡР ΤТ ΥҮ ΧХ οо ρр օо ՕО"
)
# The letters that Kyrgyz is written with.
OWN_CYRILLIC = "абвгдеёжзийклмнңоөпрстуүфхцчшщъыьэюя"

SCRIPTS = ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "LISU")

_KEPT_TAGS = ("<super>", "<sub>", "<fraction>", "<circle>", "<square>", "<vertical>", "<small>")


def _pairs(text: str) -> dict[str, str]:
    return {p[0]: p[1] for p in text.split()}


def _script(ch: str) -> str:
    name = unicodedata.name(ch, "")
    for script in SCRIPTS:
        if name.startswith(script) or f" {script} " in name:
            return script.lower()
    return "other"


def _plain(ch: str) -> str:
    """What ch becomes whatever the row's script: '' for the invisible, a space, a compatibility form, or ch itself."""
    kind = unicodedata.category(ch)
    if kind == "Cf" or "︀" <= ch <= "️" or ch in "͏ᅟᅠㅤ឴឵":
        return ""
    if kind == "Zs":
        return " "
    tag = unicodedata.decomposition(ch).split(" ")[0]
    if tag.startswith("<") and tag not in _KEPT_TAGS and ch != "…":
        form = unicodedata.normalize("NFKC", ch)
        # an accent that stands alone decomposes to a space and a mark; typographic dots and dashes stay
        return ch if form.startswith(" ") or not any(c.isalnum() for c in form) and tag != "<wide>" and tag != "<narrow>" else form
    if tag and not tag.startswith("<") and unicodedata.normalize("NFC", ch) != ch:
        return unicodedata.normalize("NFC", ch)
    return ch


def _parts(text: str) -> list[tuple[str, int, bool]]:
    """(character, combining class, joins) of the full canonical decomposition; joins: it may compose with what precedes."""
    return [(c, unicodedata.combining(c), c in joining()) for c in unicodedata.normalize("NFD", text)]


def _look(one: str, pairs: dict[str, str]) -> str | None:
    """The look-alike of a letter by its base, its accents kept."""
    base, *marks = unicodedata.normalize("NFD", one)
    return unicodedata.normalize("NFC", pairs[base] + "".join(marks)) if base in pairs else None


@cache
def code_points() -> list[tuple]:
    """The mapping table: (ch, plain, latin, cyrillic, letter, own_latin, own_cyrillic, mark, class, and parts of the three).

    plain holds the compatibility form; latin and cyrillic the look-alike in that script or null; class the canonical
    combining class; the parts of each are its full canonical decomposition. Characters that are not in the table are
    ordinary: they stand for themselves, are letters of no known script and have no parts. Hangul syllables are left to
    hangul().
    """
    latin, cyrillic = _pairs(LATIN_LOOKALIKES), _pairs(CYRILLIC_LOOKALIKES)
    own = set(OWN_CYRILLIC) | set(OWN_CYRILLIC.upper())
    rows = []
    for point in range(32, sys.maxunicode + 1):
        ch = chr(point)
        kind = unicodedata.category(ch)
        if kind in ("Cn", "Co", "Cs") or 0xAC00 <= point <= 0xD7A3:
            continue
        plain, letter, mark = _plain(ch), kind[0] == "L", kind[0] == "M"
        script = _script(plain[0]) if plain and letter else "none"
        known = letter and script != "none" and script != "other"
        if plain != ch or mark and unicodedata.combining(ch) or known or ch in joining() or unicodedata.decomposition(ch)[:1] not in ("", "<"):
            one = plain if len(plain) == 1 else ch
            looks = _look(one, latin) if known else None, _look(one, cyrillic) if known else None
            rows.append((
                ch, plain, *looks, known, script == "latin" and one not in latin, script == "cyrillic" and one in own,
                mark, unicodedata.combining(ch), _parts(plain), *(x and _parts(x) for x in looks),
            ))
    return rows


@cache
def compositions() -> dict[str, str]:
    """Canonical pairs of a starter and what composes with it, and the precomposed character of each; no Hangul."""
    out = {}
    for point in range(0xC0, sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(point)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            pair = "".join(chr(int(x, 16)) for x in parts)
            if unicodedata.normalize("NFC", pair) == chr(point):
                out[pair] = chr(point)
    return out


@cache
def joining() -> frozenset[str]:
    """Characters of class 0 that compose with what precedes them: vowel signs of some scripts, and conjoining Hangul."""
    return frozenset(p[1] for p in compositions() if not unicodedata.combining(p[1])) | frozenset(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))


@cache
def levels() -> int:
    """Most compositions that one starter goes through."""
    return max(len(unicodedata.normalize("NFD", c)) for c in compositions().values()) - 1


_PARTS = "array<struct<ch string, ccc int, joins boolean>>"
_made: dict[tuple, DataFrame] = {}


def _once(name: str, spark: SparkSession, make) -> DataFrame:
    """A fixed table, made once a session: turning its rows into a DataFrame takes longer than using it."""
    key = (name, spark.sparkContext.applicationId, id(spark))
    if key not in _made:
        _made[key] = make()
    return _made[key]


def mapping_table(spark: SparkSession) -> DataFrame:
    return _once("mapping", spark, lambda: spark.createDataFrame(
        code_points(),
        "ch string, plain string, latin string, cyrillic string, letter boolean, own_latin boolean, own_cyrillic boolean, mark boolean, ccc int, "
        f"parts {_PARTS}, latin_parts {_PARTS}, cyrillic_parts {_PARTS}",
    ))


def hangul(spark: SparkSession) -> DataFrame:
    """(syllable, lead, vowel, tail, open): every Hangul syllable with its letters, tail null where it ends in a vowel,
    and open the syllable without its tail."""

    def letter(base: int, offset: Column) -> Column:
        return F.decode(F.to_binary(F.lpad(F.hex(offset + base), 8, "0"), F.lit("hex")), "utf-32")

    i = F.col("id")
    tail = i % 28
    return spark.range(0, 11172, 1, 1).select(
        letter(0xAC00, i).alias("syllable"), letter(0x1100, F.floor(i / 588)).alias("lead"), letter(0x1161, F.floor(i % 588 / 28)).alias("vowel"),
        F.when(tail > 0, letter(0x11A7, tail)).alias("tail"), letter(0xAC00, i - tail).alias("open"),
    )


def pair_table(spark: SparkSession) -> DataFrame:
    """(starter, second, composed): all canonical pairs."""
    pairs = _once("pairs", spark, lambda: spark.createDataFrame([(*p, c) for p, c in sorted(compositions().items())], "starter string, second string, composed string"))
    h = hangul(spark)
    return pairs.unionByName(h.select(
        F.when(F.col("tail").isNull(), F.col("lead")).otherwise(F.col("open")).alias("starter"), F.coalesce("tail", "vowel").alias("second"), F.col("syllable").alias("composed")
    ))


def _char_class(chars) -> str:
    """A Java character class of the given characters, as ranges."""
    points = sorted(map(ord, chars))
    ranges, start = [], None
    for a, b in zip(points, points[1:] + [None]):
        start = a if start is None else start
        if b != a + 1:
            ranges.append(f"\\x{{{start:x}}}-\\x{{{a:x}}}")
            start = None
    return "[" + "".join(ranges) + "]"


@cache
def _odd() -> tuple[str, str]:
    """Patterns of a character that may change or may not be known here, for Latin and for Cyrillic rows.

    Both are complements of ordinary characters of the common blocks: a text without a match is ordinary for certain.
    """
    blocks = [*range(0x20, 0x530), *range(0x2010, 0x2028), *range(0x2030, 0x2050)]
    latin = cyrillic = {chr(p) for p in blocks} | {"\t", "\n", "\r"}
    latin = latin - {r[0] for r in code_points() if r[1] != r[0] or r[2] or r[7]}
    cyrillic = cyrillic - {r[0] for r in code_points() if r[1] != r[0] or r[3] or r[7]}
    return _char_class(latin).replace("[", "[^", 1), _char_class(cyrillic).replace("[", "[^", 1)


def suspect(text: Column, cyrillic: Column) -> Column:
    """Whether a text may differ from its canonical form."""
    latin, cyr = _odd()
    return F.when(cyrillic, text.rlike(cyr)).otherwise(text.rlike("[^ -~]") & text.rlike(latin))


@cache
def _moving() -> str:
    """A pattern of characters that compose with, or are ordered among, what precedes them."""
    return _char_class(r[0] for r in code_points() if r[9] and (r[9][0][1] or r[9][0][2]))


def _judged(points: DataFrame, table: DataFrame, key: list[str], *more: str) -> DataFrame:
    """Code points with what becomes of them: _swap says whether the look-alike takes the letter's place."""
    mapped = points.join(F.broadcast(table), "ch", "left").select(
        *key, "_pos", "_text", "ch", "plain", F.when(F.col("_cyr"), F.col("cyrillic")).otherwise(F.col("latin")).alias("_look"), "_cyr", *more,
        (F.coalesce("letter", F.lit(False)) & ~F.when(F.col("_cyr"), F.col("own_cyrillic")).otherwise(F.col("own_latin"))).alias("_foreign"),
        (F.coalesce("letter", F.lit(False)) | F.coalesce("mark", F.lit(False)) | F.coalesce(F.col("plain") == "", F.lit(False))).alias("_inside"),
    )
    # a word is a run of letters; marks and invisible characters don't end it
    in_order = Window.partitionBy(*key).orderBy("_pos")
    words = mapped.withColumn("_word", F.sum(F.when(F.col("_inside"), 0).otherwise(1)).over(in_order))
    # a foreign letter gives way only where every foreign letter of its word has a look-alike of the row's own script
    all_ = F.min(F.when(F.col("_foreign"), F.col("_look").isNotNull())).over(Window.partitionBy(*key, "_word"))
    return words.withColumn("_swap", F.col("_foreign") & all_)


def _recomposed(clusters: DataFrame, key: list[str]) -> DataFrame:
    """Clusters (key..., head, rest): each starter composed, level by level, with the parts that follow it.

    rest holds parts (ccc, ch) in canonical order. A part composes unless one before it has its class or a greater one,
    or class 0; what has been passed over isn't tried again (from). A level looks all pairs up in one broadcast join and
    takes the first.
    """
    spark = clusters.sparkSession
    pairs = F.broadcast(pair_table(spark))
    state = clusters.withColumn("from", F.lit(0))
    for _ in range(levels()):
        free = F.transform("rest", lambda x, i: F.struct(
            i.alias("i"), x["ch"].alias("ch"),
            ((i >= F.col("from")) & ((i == 0) | ((x["ccc"] > 0) & ~F.exists(F.slice("rest", 1, i), lambda y: (y["ccc"] == 0) | (y["ccc"] >= x["ccc"]))))).alias("ok"),
        ))
        tried = state.withColumn("x", F.explode_outer(F.filter(free, lambda x: x["ok"]))).select("*", F.col("x.i").alias("_i"), F.col("x.ch").alias("_second"))
        hit = tried.join(pairs, (F.col("head") == F.col("starter")) & (F.col("_second") == F.col("second")), "left")
        state = hit.groupBy(*key).agg(
            F.first("_text").alias("_text"), F.first("head").alias("head"), F.first("rest").alias("rest"), F.first("from").alias("from"),
            F.min(F.when(F.col("composed").isNotNull(), F.struct("_i", "composed"))).alias("_hit"),
        )
        i = F.col("_hit._i")
        state = state.select(
            *key, "_text", F.coalesce("_hit.composed", "head").alias("head"),
            F.when(i.isNull(), F.col("rest")).otherwise(F.concat(F.slice("rest", 1, i), F.slice("rest", i + 2, F.size("rest")))).alias("rest"),
            F.coalesce(i, "from").alias("from"),
        )
    return state


def _joined_text(rows: DataFrame, key: list[str]) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct("_pos", "_new")))
    return rows.groupBy(*key).agg(F.max("_text").alias("_text"), F.array_join(F.transform(parts, lambda x: x["_new"]), "").alias("_canonical"))


def _rebuilt(placed: DataFrame, marks: bool) -> DataFrame:
    """Canonical forms of texts placed by _id; marks: whether parts have to be ordered and composed."""
    spark, key = placed.sparkSession, ["_src", "_id", "_k"]
    points = placed.select(*key, "_cyr", "_text", F.posexplode(F.split("_text", "")).alias("_pos", "ch")).where("ch <> ''")
    points = points.withColumn("_text", F.when(F.col("_pos") == 0, F.col("_text")))
    table = mapping_table(spark)
    if not marks:
        judged = _judged(points, table.drop("parts", "latin_parts", "cyrillic_parts"), key)
        return _joined_text(judged.select(*key, "_pos", "_text", F.when(F.col("_swap"), F.col("_look")).otherwise(F.coalesce("plain", "ch")).alias("_new")), key)

    def part(ch: Column, joins: bool) -> Column:
        return F.struct(ch.alias("ch"), F.lit(0).alias("ccc"), F.lit(joins).alias("joins"))

    syllables = hangul(spark).select(
        F.col("syllable").alias("ch"), F.col("syllable").alias("plain"), F.lit(False).alias("letter"), F.lit(False).alias("mark"),
        F.filter(F.array(part(F.col("lead"), False), part(F.col("vowel"), True), part(F.col("tail"), True)), lambda x: x["ch"].isNotNull()).alias("parts"),
    )
    judged = _judged(points, table.unionByName(syllables, allowMissingColumns=True), key, "parts", "latin_parts", "cyrillic_parts")
    looks = F.when(F.col("_cyr"), F.col("cyrillic_parts")).otherwise(F.col("latin_parts"))
    own = F.when(F.col("_swap"), looks).otherwise(F.coalesce("parts", F.array(part(F.col("ch"), False))))
    parts = judged.select(*key, "_pos", "_text", F.posexplode_outer(own).alias("_sub", "p")).select(
        *key, "_pos", "_text", "_sub", F.coalesce("p.ch", F.lit("")).alias("ch"), F.coalesce("p.ccc", F.lit(0)).alias("ccc"), F.coalesce("p.joins", F.lit(False)).alias("joins")
    )
    # what has become invisible is gone, but for the row that holds the text
    parts = parts.where("ch <> '' OR _text IS NOT NULL")
    in_order = Window.partitionBy(*key).orderBy("_pos", "_sub")
    starts = (F.col("ccc") == 0) & ~F.col("joins") & (F.col("ch") != "")
    parts = parts.withColumns({
        "_base": F.sum(starts.cast("int")).over(in_order),
        # marks are ordered between the conjoining letters, not across them
        "_run": F.sum((F.col("joins") & (F.col("ccc") == 0)).cast("int")).over(in_order),
    })
    held = F.sort_array(F.collect_list(F.struct("_run", "ccc", "_pos", "_sub", "ch")))
    clusters = parts.groupBy(*key, "_base").agg(F.max("_text").alias("_text"), held.alias("c"))
    rest = F.transform(F.slice("c", 2, F.size("c")), lambda x: F.struct(x["ccc"], x["ch"]))
    clusters = clusters.select(*key, F.col("_base").alias("_pos"), "_text", F.col("c")[0]["ch"].alias("head"), rest.alias("rest"))
    alone = F.size("rest") == 0
    composed = _recomposed(clusters.where(~alone), [*key, "_pos"])
    new = F.concat("head", F.array_join(F.transform("rest", lambda x: x["ch"]), "")).alias("_new")
    return _joined_text(clusters.where(alone).select(*key, "_pos", "_text", F.col("head").alias("_new")).unionByName(composed.select(*key, "_pos", "_text", new)), key)


def canonical_suspects(rows: DataFrame) -> DataFrame:
    """(_src, _id, _text, _cyr) in, (_src, _id, _k, _text, _canonical) out, one row per distinct row of the input.

    The rows are placed once by id and a hash of text and script, _k, so neither null nor repeated ids go to one task;
    all windows, groups and joins below find them there.
    """
    placed = rows.select("_src", "_id", "_text", "_cyr", _text_key().alias("_k")).repartition(width(rows.sparkSession), "_id", "_k").dropDuplicates(["_src", "_id", "_k"])
    marked = F.col("_text").rlike(_moving())
    return _rebuilt(placed.where(~marked), False).unionByName(_rebuilt(placed.where(marked), True))


def _text_key() -> Column:
    return F.xxhash64("_text", "_cyr")


def _cyrillic(lang: Column, languages=("ky", "ru")) -> Column:
    return F.coalesce(F.lower(F.left(lang, F.lit(2))).isin(*languages), F.lit(False))


def lookalike_rows(tables: list[tuple[str, DataFrame, str, str, str]]) -> DataFrame:
    """Texts that are not in canonical form: (src_table, row_id, text, canonical), one row per distinct row and text.

    tables: (name, rows, id column, text column, language column). Null and empty texts are in canonical form. The row's
    own script is Cyrillic if its language is, Latin otherwise, also for a null language. Other columns are ignored.
    """
    parts = []
    for name, df, row_id, text, lang in tables:
        rows = df.select(F.lit(name).alias("_src"), col(row_id).alias("_id"), col(text).alias("_text"), _cyrillic(col(lang)).alias("_cyr"))
        parts.append(rows.where(suspect(F.col("_text"), F.col("_cyr"))))
    rows = parts[0]
    for other in parts[1:]:
        rows = rows.unionByName(other)
    out = canonical_suspects(rows)
    return out.where(F.col("_canonical") != F.col("_text")).select(
        F.col("_src").alias("src_table"), F.col("_id").alias("row_id"), F.col("_text").alias("text"), F.col("_canonical").alias("canonical")
    )


def canonical_texts(df: DataFrame, row_id: str, text: str, lang: str) -> DataFrame:
    """Every row as (row_id, text, canonical): equal-looking texts are equal in canonical. Null stays null.

    Repeated rows come out as often as they come in.
    """
    rows = df.select(F.lit("").alias("_src"), col(row_id).alias("_id"), col(text).alias("_text"), _cyrillic(col(lang)).alias("_cyr"))
    odd = F.coalesce(suspect(F.col("_text"), F.col("_cyr")), F.lit(False))
    fine = rows.where(~odd).select(F.col("_id").alias("row_id"), F.col("_text").alias("text"), F.col("_text").alias("canonical"))
    suspects = rows.where(odd).withColumn("_k", _text_key())
    forms = canonical_suspects(rows.where(odd)).select(F.col("_id").alias("_i"), F.col("_k").alias("_h"), F.col("_text").alias("_t"), "_canonical")
    joined = suspects.join(forms, (F.col("_k") == F.col("_h")) & F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_text") == F.col("_t")))
    return fine.unionByName(joined.select(F.col("_id").alias("row_id"), F.col("_text").alias("text"), F.col("_canonical").alias("canonical")))
