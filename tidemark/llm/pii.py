"""Personal data replaced by keyed surrogates, in DataFrame functions only.

One pattern finds e-mail addresses, IBANs, IPv4 addresses, social-security,
card and phone numbers; persons are found after a title or words that introduce
them, and within a document the names so found are found again without. A
surrogate is derived from a keyed hash (HMAC) of the entity's kind and canonical
form (case and separators dropped), so every mention of an entity, in every
document, gets the same one, written in the mention's own format: letters for
letters, digits for digits, separators and capitals in place. Cards keep their
issuer digit and Luhn remainder, IBANs their country and remainder by 97, phone
numbers their first digit, addresses their top-level domain. A name's surrogate is
a stem of syllables of its script, one for each name, with an ending for the
gender that the mention's title tells (or that of the document's first title).

Distinctness is checked, not hoped for: over the distinct entities of the corpus,
a surrogate that equals another entity's surrogate, or any real entity of its
kind, is refused, and its entity draws again in the next round until none is
refused. From round ROUNDS on surrogates grow by a letter or digit a round, so a
format too small for its entities ends the search as well. Only entities and their
rounds are shuffled. Texts stay in place: the first draw is computed where the
mention is, and the few later rounds reach their documents as a small map.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import cut, keep

#: Titles by the gender they tell, in several languages; the last row tells none.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Madame", "Mme", "Mlle", "Mademoiselle", "Señora", "Sra", "Señorita", "Srta", "Doña", "Signora", "госпожа", "г-жа", "κυρία"),
    "m": ("Mr", "Mister", "Sir", "Lord", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин", "г-н", "κύριος"),
    "n": ("Dr", "Prof", "Professor", "Doctor"),
}
#: Consonants, vowels and the endings for f, m, n by script.
SCRIPTS = {
    "latin": ("bdfgklmnprstvzjh", "aeiou", ("a", "o", "e")),
    "cyrillic": ("бдгклмнпрствзфжх", "аеиоу", ("а", "ий", "о")),
    "greek": ("βγδζθκλμνπρστφχξ", "αεηοι", ("α", "ος", "ι")),
}
#: Words before a first and last name that introduce a person.
CUES = ("my name is", "My name is", "name:", "Name:", "contact", "Contact", "contact:", "Contact:", "signed", "Signed", "Sincerely,", "mein Name ist", "Mein Name ist", "ich heiße", "Ich heiße", "me llamo", "Me llamo", "mi nombre es", "Mi nombre es", "je m'appelle", "Je m'appelle", "mon nom est", "Mon nom est")
#: Rounds in which a surrogate has the length of its entity.
ROUNDS = 64
#: For tests and the query; who publishes surrogates passes a key of their own.
OPEN_KEY = "an open key"

_NAME = r"\p{Lu}[\p{L}'’]++(?:-\p{Lu}[\p{L}'’]++)*+"
_TITLE = "|".join(sorted((t for row in TITLES.values() for t in row), key=len, reverse=True))
_CUE = "|".join(sorted(CUES, key=len, reverse=True))
PERSON = rf"(?<![\p{{L}}\p{{N}}])(?:(?:{_TITLE})(?:\.|(?![\p{{L}}\p{{N}}]))\x20?(?:{_NAME})|(?:{_CUE})\x20{_NAME}\x20{_NAME})(?:\x20{_NAME}){{0,2}}+"
#: In order: e-mail, IBAN, IPv4, social security, card, phone.
PATTERN = "|".join(
    (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9])",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"(?<![0-9A-Za-z])[2-6](?:[\x20-]?[0-9]){12,18}(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){2,4}|\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    )
)
KINDS = ("email", "iban", "ip", "ssn", "card", "phone", "name")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind_sql(m: str) -> str:
    """Kind of a mention that PATTERN found."""
    return f"""CASE WHEN {m} LIKE '%@%' THEN 'email' WHEN {m} RLIKE '^[A-Z]' THEN 'iban'
      WHEN {m} RLIKE '^[0-9]+(\\\\.[0-9]+){{3}}$' AND length({m}) <= 15 THEN 'ip'
      WHEN {m} RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN 'ssn'
      WHEN {m} RLIKE '^[0-9][0-9 -]*$' AND length(translate({m}, ' -', '')) >= 13 THEN 'card' ELSE 'phone' END"""


def canonical_sql(m: str) -> str:
    return f"""CASE {kind_sql(m)} WHEN 'email' THEN lower({m}) WHEN 'iban' THEN replace({m}, ' ', '')
      WHEN 'ip' THEN {m} ELSE regexp_replace({m}, '[^0-9]', '') END"""


def _name_sql(kind: str, h: str, again: str) -> str:
    """The stem of a name for a kind name:<script>; each round has a syllable more."""
    cases = []
    for script, (consonants, vowels, _) in SCRIPTS.items():
        pick = f"""array_join(transform(sequence(1, 3 + least({again}, 20)), k -> concat(
            substring('{consonants}', 1 + pmod(cast(conv(substring({h}, 4 * k - 3, 2), 16, 10) as int), {len(consonants)}), 1),
            substring('{vowels}', 1 + pmod(cast(conv(substring({h}, 4 * k - 1, 2), 16, 10) as int), {len(vowels)}), 1))), '')"""
        cases.append(f"WHEN {kind} = 'name:{script}' THEN {pick}")
    return f"CASE {' '.join(cases)} END"


def hmac_sql(key: str, message: str) -> str:
    """HMAC-SHA-512 of a string, in hexadecimal."""
    raw = key.encode()
    block = (hashlib.sha512(raw).digest() if len(raw) > 128 else raw).ljust(128, b"\0")
    inner, outer = (bytes(b ^ pad for b in block).hex() for pad in (0x36, 0x5C))
    return f"sha2(concat(X'{outer}', unhex(sha2(concat(X'{inner}', encode({message}, 'UTF-8')), 512))), 512)"


def _mod97_sql(iban: str) -> str:
    """Remainder by 97 of an IBAN, its first four characters last and letters as 10 to 35."""
    moved = f"concat(substring({iban}, 5), substring({iban}, 1, 4))"
    value = "if(c RLIKE '[0-9]', cast(c as int), ascii(c) - 55)"
    return f"aggregate(split({moved}, ''), 0, (a, c) -> if(c = '', a, pmod(a * if(c RLIKE '[0-9]', 10, 100) + {value}, 97)))"


def surrogate_sql(key: str, kind: str, canon: str, again: str) -> str:
    """Canonical surrogate of an entity in a round; of a name, its stem."""
    luhn = "aggregate(sequence(1, length({0})), 0, (a, k) -> a + element_at(if(pmod(k, 2) = 0, array(0,2,4,6,8,1,3,5,7,9), array(0,1,2,3,4,5,6,7,8,9)), 1 + cast(substring({0}, length({0}) + 1 - k, 1) as int)))"
    # a letter or digit for each letter or digit from v.a to v.b, all else as it is
    shaped = """array_join(transform(sequence(1, length(v.c)), k -> CASE
        WHEN k < v.a OR k > v.b THEN substring(v.c, k, 1)
        WHEN substring(v.c, k, 1) RLIKE '[0-9]' THEN cast(pmod(cast(conv(substring(v.h, 1 + 2 * pmod(k, 64), 2), 16, 10) as int), 10) as string)
        WHEN substring(v.c, k, 1) RLIKE '[a-z]' THEN char(97 + pmod(cast(conv(substring(v.h, 1 + 2 * pmod(k, 64), 2), 16, 10) as int), 26))
        WHEN substring(v.c, k, 1) RLIKE '[A-Z]' THEN char(65 + pmod(cast(conv(substring(v.h, 1 + 2 * pmod(k, 64), 2), 16, 10) as int), 26))
        ELSE substring(v.c, k, 1) END), '')"""
    octets = "array_join(transform(sequence(1, 4), k -> cast(1 + pmod(cast(conv(substring(v.h, 4 * k, 4), 16, 10) as int), 254) as string)), '.')"
    # the last digit puts right the remainder, here of what stands before it
    card = f"""transform(array({shaped}), s -> concat(s, cast(pmod({luhn.format("v.c")} - {luhn.format("concat(s, '0')")}, 10) as string)))[0]"""
    card = card.replace(f"array({shaped})", "array(substring(" + shaped + ", 1, length(v.c) - 1))")
    zeroed = f"concat(substring(v.c, 1, 2), '00', substring({shaped}, 5))"
    iban = f"""transform(array({zeroed}), s -> transform(array(pmod({_mod97_sql("v.c")} - {_mod97_sql("s")}, 97)), d ->
        concat(substring(s, 1, 2), lpad(cast(if(d < 2, d + 97, d) as string), 2, '0'), substring(s, 5)))[0])[0]"""
    more = f"if({again} < {ROUNDS}, '', array_join(transform(sequence(1, least({again} - {ROUNDS} + 1, 40)), k -> cast(pmod(cast(conv(substring(v.h, 2 * k, 2), 16, 10) as int), 10) as string)), ''))"
    return f"""transform(array(named_struct('c', {canon}, 'h', {hmac_sql(key, f"concat(length({kind}), ':', {kind}, length({canon}), ':', {canon}, cast({again} as string))")},
        'a', CASE {kind} WHEN 'email' THEN 1 WHEN 'iban' THEN 5 WHEN 'ssn' THEN 1 ELSE 2 END,
        'b', CASE {kind} WHEN 'email' THEN length({canon}) - length(substring_index({canon}, '.', -1)) ELSE length({canon}) END)), v ->
      CASE WHEN {kind} LIKE 'name:%' THEN {_name_sql(kind, "v.h", again)} WHEN {kind} = 'ip' THEN {octets}
           WHEN {kind} = 'card' THEN concat({card}, {more}) WHEN {kind} = 'iban' THEN concat({iban}, {more})
           WHEN {kind} = 'email' THEN concat({more}, {shaped}) ELSE concat({shaped}, {more}) END)[0]"""


def render_sql(m: str, kind: str, s: str, gender: str) -> str:
    """The surrogate in the mention's format; what it is longer than the mention follows at the end (of an e-mail address, first)."""
    digits = f"""concat(array_join(transform(sequence(1, length({m})), k -> if(substring({m}, k, 1) RLIKE '[0-9]',
        substring({s}, length(regexp_replace(substring({m}, 1, k), '[^0-9]', '')), 1), substring({m}, k, 1))), ''),
        substring({s}, 1 + length(regexp_replace({m}, '[^0-9]', ''))))"""
    over = f"greatest(length({s}) - length({m}), 0)"
    letters = f"""concat(substring({s}, 1, {over}), array_join(transform(sequence(1, length({m})), k -> if(substring({m}, k, 1) RLIKE '[A-Z]',
        upper(substring({s}, k + {over}, 1)), substring({s}, k + {over}, 1))), ''))"""
    spaced = f"""concat(array_join(transform(sequence(1, length({m})), k -> if(substring({m}, k, 1) = ' ', ' ',
        substring({s}, length(replace(substring({m}, 1, k), ' ', '')), 1))), ''), substring({s}, 1 + length(replace({m}, ' ', ''))))"""
    ending = " ".join(f"WHEN {kind} = 'name:{script}' AND {gender} = '{g}' THEN '{e}'" for script, (_, _, endings) in SCRIPTS.items() for g, e in zip("fmn", endings))
    full = f"concat({s}, CASE {ending} ELSE '' END)"
    name = f"if(length({m}) > 1 AND {m} = upper({m}), upper({full}), initcap({full}))"
    return f"CASE WHEN {kind} LIKE 'name:%' THEN {name} WHEN {kind} = 'email' THEN {letters} WHEN {kind} = 'iban' THEN {spaced} WHEN {kind} = 'ip' THEN {s} ELSE {digits} END"


def _with_names(docs: DataFrame) -> DataFrame:
    """Adds _names: lower-cased name to its kind and gender, from the persons named after a title or cue."""
    gender = " ".join(f"WHEN p RLIKE {_quoted('^(?:' + '|'.join(TITLES[g]) + ')(?![\\\\p{L}\\\\p{N}])')} THEN '{g}'" for g in "fm")
    script = "CASE WHEN w RLIKE '\\\\p{IsCyrillic}' THEN 'cyrillic' WHEN w RLIKE '\\\\p{IsGreek}' THEN 'greek' ELSE 'latin' END"
    title = rf"^(?:(?:{_CUE})\x20|(?:{_TITLE})(?:\.|(?![\p{{L}}\p{{N}}]))\x20?)"
    persons = F.when(F.col("text").rlike(PERSON), F.regexp_extract_all("text", F.lit(PERSON), F.lit(0))).otherwise(F.array().cast("array<string>"))
    docs = docs.withColumn("_persons", persons)
    # the last of several names is the family's, whatever the gender; a name after a title alone too
    entries = f"""flatten(transform(_persons, p -> transform(array(named_struct('g', CASE {gender} ELSE 'n' END, 'w', split(regexp_replace(p, {_quoted(title)}, ''), ' '))), q ->
        transform(q.w, (w, k) -> named_struct('w', lower(w), 'k', named_struct('kind', concat('name:', {script}), 'gender', if(k < size(q.w) - 1, q.g, 'l')))))[0]))"""
    return docs.withColumn("_entries", F.expr(entries)).withColumn("_names", F.expr("aggregate(_entries, cast(map() as map<string,struct<kind:string,gender:string>>), (a, e) -> if(map_contains_key(a, e.w), a, map_concat(a, map(e.w, e.k))))")).drop("_entries", "_persons")


def find_mentions(docs: DataFrame) -> DataFrame:
    """Adds _gaps and _found, the text split at its mentions, and each mention's kind and canonical form."""
    docs = _with_names(docs)
    escaped = F.array_join(F.transform(F.map_keys("_names"), lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E"))), "|")
    own = F.concat(F.lit(PATTERN + r"|(?<![\p{L}\p{N}])(?iu:"), escaped, F.lit(r")(?![\p{L}\p{N}])"))
    has_names = F.size("_names") > 0
    any_digit = F.col("text").rlike("[0-9@]")
    none = F.array().cast("array<string>")
    found = F.when(has_names, F.regexp_extract_all("text", own, F.lit(0))).when(any_digit, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(none)
    docs = docs.withColumn("_found", found)
    gaps = F.when(F.size("_found") == 0, F.array("text")).when(has_names, F.call_function("split", "text", own, F.lit(-1))).otherwise(F.split("text", PATTERN, -1))
    # a capital first tells a name from a word that is written the same
    # and a title right before it tells this mention's gender, if it is a given name anywhere
    before = "substring(_gaps[i], -20)"
    gender = " ".join(f"WHEN {before} RLIKE {_quoted('(?<![\\p{L}\\p{N}])(?:' + '|'.join(TITLES[g]) + ')\\.?\\x20?$')} THEN '{g}'" for g in "fmn")
    entity = f"""transform(_found, (m, i) -> CASE WHEN map_contains_key(_names, lower(m)) THEN if(m RLIKE '^\\\\p{{Lu}}', named_struct('kind', _names[lower(m)].kind, 'canon', lower(m),
            'gender', if(_names[lower(m)].gender = 'l', 'l', CASE {gender} ELSE _names[lower(m)].gender END)), null)
        ELSE named_struct('kind', {kind_sql("m")}, 'canon', {canonical_sql("m")}, 'gender', '') END)"""
    return docs.withColumn("_gaps", gaps).withColumn("_entity", F.expr(entity))


def later_rounds(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, again (1 or more) of entities whose first surrogate was refused.

    Each round refuses a surrogate that is a real entity of its kind (a name's
    stem, if with any ending it is), that an accepted entity has, or that an entity
    earlier in order draws too.
    """
    draw = lambda df, again: df.withColumn("_s", F.expr(surrogate_sql(key, "kind", "canon", str(again))))
    real = entities.select("kind", F.explode(F.expr("if(kind LIKE 'name:%', array(canon, left(canon, length(canon) - 1), left(canon, length(canon) - 2)), array(canon))")).alias("_s"))
    pending, taken, later = entities, None, []
    for again in count():
        drawn = draw(pending, again)
        least = drawn.groupBy("kind", "_s").agg(F.min("canon").alias("_least"))
        drawn = drawn.join(least, ["kind", "_s"]).withColumn("_ok", F.col("canon") == F.col("_least")).drop("_least")
        barred = real if taken is None else real.unionByName(taken)
        drawn = drawn.join(barred.distinct().withColumn("_bar", F.lit(True)), ["kind", "_s"], "left")
        drawn = keep(drawn.withColumn("_ok", F.col("_ok") & F.col("_bar").isNull()).drop("_bar"))
        good = drawn.filter("_ok").select("kind", "canon", "_s")
        if again:
            later.append(good.select("kind", "canon", F.lit(again).alias("again")))
        pending = drawn.filter("NOT _ok").select("kind", "canon")
        if pending.isEmpty():
            break
        pending = cut(pending)
        taken = good.select("kind", "_s") if taken is None else taken.unionByName(good.select("kind", "_s"))
    if not later:
        return entities.limit(0).withColumn("again", F.lit(0))
    return reduce(DataFrame.unionByName, later)


def replace_pii(docs: DataFrame, key: str = OPEN_KEY, broadcast_rows: int = 100_000) -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_entities, and a count per kind.

    Defined cases: a null text stays null with counts 0; empty texts and texts
    without a mention stay as they are; texts of any length are read whole; equal
    rows get equal results; null ids are carried; an empty table gives no rows;
    other columns are ignored. Where a format has no free surrogate left, its
    entities get longer ones. Who knows the key can test guesses; the default key is
    open.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    work = find_mentions(base.withColumn("_null", F.col("text").isNull()).withColumn("text", F.coalesce("text", F.lit(""))))
    entities = keep(work.select(F.explode("_entity").alias("e")).filter("e IS NOT NULL").select("e.kind", "e.canon").distinct())
    later = keep(later_rounds(entities, key))
    work = work.withColumn("_key", F.xxhash64("text"))
    if later.isEmpty():
        work = work.withColumn("_again", F.expr("cast(map() as map<string,int>)"))
    else:
        # documents that mention an entity of a later round get a map of those
        mentions = work.select("doc_id", "_key", F.explode("_entity").alias("e")).filter("e IS NOT NULL").select("doc_id", "_key", "e.kind", "e.canon").distinct()
        maps = mentions.join(later, ["kind", "canon"]).groupBy("doc_id", "_key").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "canon"), "again"))).alias("_again"))
        maps = keep(maps.withColumnsRenamed({"doc_id": "_d", "_key": "_k"}))
        side = F.broadcast(maps) if maps.count() <= broadcast_rows else maps
        work = work.join(side, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    again = "coalesce(element_at(_again, concat_ws('|', e.kind, e.canon)), 0)"
    written = f"""zip_with(_found, _entity, (m, e) -> if(e IS NULL, m, transform(array({surrogate_sql(key, "e.kind", "e.canon", again)}), s -> {render_sql("m", "e.kind", "s", "e.gender")})[0]))"""
    text = f"""if(size(_found) = 0, text, array_join(zip_with(_gaps, {written}, (g, w) -> concat(g, coalesce(w, ''))), ''))"""
    number = [F.expr(f"cast(size(filter(_entity, e -> e IS NOT NULL AND e.kind LIKE '{k}%')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return work.select("doc_id", F.expr(f"if(_null, null, {text})").alias("text"), F.expr("cast(size(filter(_entity, e -> e IS NOT NULL)) as bigint)").alias("n_entities"), *number)
