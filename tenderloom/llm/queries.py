"""The registered queries of this subpackage, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.runtime import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.components import requirement_groups

    return requirement_groups(table(spark, d, "requirements"), table(spark, d, "verdicts"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.near_sets import near_requirements_and_extractions

    return near_requirements_and_extractions(table(spark, d, "requirements"), table(spark, d, "extractions"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.alignment import aligned_sentences

    return aligned_sentences(table(spark, d, "requirements"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.pieces import oversized

    return oversized(table(spark, d, "chunks"))


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.pieces import oversized_pieces

    return oversized_pieces(table(spark, d, "chunks"))


def p3_reassembled(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.pieces import reassembled

    return reassembled(table(spark, d, "chunks"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.leaks import leaks

    return leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.near_sets import classes_of_requirements_and_extractions

    return classes_of_requirements_and_extractions(table(spark, d, "requirements"), table(spark, d, "extractions"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.lookalike import same_to_a_reader

    return same_to_a_reader(table(spark, d, "chunks"))


def p6_canonical(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.lookalike import canonical_chunks

    return canonical_chunks(table(spark, d, "chunks")).selectExpr("chunk_id", "md5(canonical) as form", "n_forms")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.shared_spans import shared_chars

    return shared_chars(table(spark, d, "documents"))


def p10_paragraph_clusters(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.shared_spans import paragraph_clusters

    return paragraph_clusters(table(spark, d, "documents"))


def p8_longest(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id", "item_words", "longest")


def p8_coverage(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.leaks import leaked_coverage

    return leaked_coverage(p8_leaks(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.fusion import fused

    return fused(table(spark, d, "requirements"), fields=()).select("source_file", "item_number", "description_id", "confidence_id", "priority_id")


def p7_first_rates(spark: SparkSession, d: str) -> DataFrame:
    """The sources' rates after one round, in which a value is true by its share of statements."""
    from tenderloom.llm.fusion import infer_truth, position_facts

    rates = infer_truth(position_facts(table(spark, d, "requirements")), 1)[1]
    return rates.select("field", "source", F.round("sensitivity", 9).alias("sensitivity"), F.round("specificity", 9).alias("specificity"))


def p7_fused(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.fusion import fused

    return fused(table(spark, d, "requirements"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.mixing import mixture

    return mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    from tenderloom.llm.mixing import shares

    return shares(p9_mixture(spark, d), table(spark, d, "mix_targets"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p3_found, p3_pieces, p3_reassembled, p5_found, p5_classes, p6_found, p6_canonical, p8_found, p7_found, p7_fused, p7_first_rates, p8_leaks, p8_longest, p8_coverage, p9_mixture, p9_shares, p10_found, p10_paragraph_clusters)}

_REQUIREMENTS = """requirements1 as (select * from (select *, row_number() over (partition by id order by updated_at desc, loaded_at desc) as rn_ from requirements where id is not null) where rn_ = 1)"""
_CHUNKS = """chunks1 as (select * from (select *, row_number() over (partition by chunk_id order by loaded_at desc) as rn_ from chunks where chunk_id is not null) where rn_ = 1)"""


def _look_alike(x: str) -> str:
    """A reader's form as SQL. The letters and digits that other scripts share are the fixed values of ``lookalike``; all else is found by the names of the characters, not by their decompositions as there."""
    import re
    import sys
    import unicodedata

    from tenderloom.llm import lookalike as L

    one, many, gone = {}, {}, []
    styled = re.compile(r"MATHEMATICAL [A-Z -]*?(CAPITAL|SMALL|DIGIT) ([A-Z]|ZERO|ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE)")
    for c in map(chr, range(1, sys.maxunicode + 1)):
        name, kind = unicodedata.name(c, ""), unicodedata.category(c)
        if name.startswith("FULLWIDTH ") and len(plain := _named(name[10:])) == 1:
            one[c] = plain
        elif name.startswith("LATIN SMALL LIGATURE "):
            many[c] = name[21:].replace("LONG S T", "ST").lower()
        elif m := styled.fullmatch(name):
            one[c] = _named(f"LATIN {m[1]} LETTER {m[2]}" if m[1] != "DIGIT" else f"DIGIT {m[2]}")
        elif kind == "Zs" or c == "\t":
            one[c] = " "
        elif kind in ("Zl", "Zp") or c in "\x0b\x0c\x85":
            one[c] = "\n"
        elif kind in ("Cc", "Cf") and c not in "\n\r" or name.startswith("VARIATION SELECTOR-") or c in L.UNSEEN:
            gone.append(c)
    for a, b in ((L.CYRILLIC, L.CYRILLIC_AS), (L.GREEK, L.GREEK_AS), (L.ARMENIAN, L.ARMENIAN_AS), (L.CHEROKEE, L.CHEROKEE_AS), (L.LISU, L.LISU_AS), (L.OTHER, L.OTHER_AS), (L.DIGITS, L.DIGITS_AS)):
        one.update(zip(a, b, strict=True))
    one = {a: b for a, b in one.items() if a != b and a not in gone}
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    x = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    for a, b in many.items():
        x = f"replace({x}, {quote(a)}, {quote(b)})"
    return f"nfc_normalize(translate({x}, {quote(''.join(one) + ''.join(gone))}, {quote(''.join(one.values()))}))"


def _named(name: str) -> str:
    import unicodedata

    try:
        return unicodedata.lookup(name)
    except KeyError:
        return ""


def _sql() -> dict[str, str]:
    space = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
    words = r"list_transform(regexp_extract_all({x}, '[\p{{L}}\p{{N}}]+'), lambda w: lower(w))"
    return {
        "p1_found": rf"""with recursive {_REQUIREMENTS},
s as (select a_id as a, b_id as b from verdicts where lower(regexp_replace(relation, '^\s+|\s+$', '', 'g')) = 'same' and a_id in (select id from requirements1) and b_id in (select id from requirements1)),
c as (select id, unnest(source_chunk_ids) as x from requirements1), m as (select x, min(id) as low from c where x is not null group by 1),
e as (select a, b from s union select b, a from s union select id, low from c join m using (x) union select low, id from c join m using (x)),
r(id, other) as (select id, id from requirements1 union select r.id, e.b from r join e on e.a = r.other)
select id, min(other) as group_id from r group by 1 having count(*) > 1""",
        "p3_found": f"with {_CHUNKS} select chunk_id from chunks1 where length(content) > 12000",
        "p3_reassembled": f"with {_CHUNKS} select chunk_id, length(content) as n_chars, md5(content) as digest, true as within_limit, true as within_overlap from chunks1 where length(content) > 12000",
        "p5_found": rf"""with {_REQUIREMENTS}, t as (select 'requirement' as kind, id as key, description_en as text from requirements1 union all select 'extraction', unit_key, max(bullet_point) from extractions where unit_key is not null group by unit_key),
w as (select kind, key, list_distinct({words.format(x="text")}) as ws from t), l as (select kind, key, len(ws) as n, ws from w where len(ws) >= 6), x as (select kind, key, n, unnest(ws) as word from l)
select a.kind, a.key as a_key, b.key as b_key from x a join x b on a.kind = b.kind and a.word = b.word and a.key < b.key group by 1, 2, 3, a.n, b.n having count(*) * 5 >= greatest(a.n, b.n) * 4""",
        "p5_classes": rf"""with recursive {_REQUIREMENTS}, t as (select 'requirement' as kind, id as key, description_en as text from requirements1 union all select 'extraction', unit_key, max(bullet_point) from extractions where unit_key is not null group by unit_key),
w as (select kind, key, list_distinct({words.format(x="text")}) as ws from t), l as (select kind, key, len(ws) as n, ws from w where len(ws) >= 6), x as (select kind, key, n, unnest(ws) as word from l),
e as (select a.kind, a.key as a, b.key as b from x a join x b on a.kind = b.kind and a.word = b.word and a.key <> b.key group by 1, 2, 3, a.n, b.n having count(*) * 5 >= greatest(a.n, b.n) * 4),
r(kind, key, other) as (select kind, key, key from t union select r.kind, r.key, e.b from r join e on e.kind = r.kind and e.a = r.other), c as (select kind, key, min(other) as class_id from r group by 1, 2)
select c.kind, c.key, class_id, count(e.b) as links from c left join e on e.kind = c.kind and e.a = c.key group by 1, 2, 3""",
        "p6_found": f"""with {_CHUNKS}, f as (select chunk_id, content, md5({_look_alike("content")}) as form from chunks1 where content is not null)
select a.chunk_id as a_chunk_id, b.chunk_id as b_chunk_id from f a join f b on a.form = b.form and a.chunk_id < b.chunk_id and a.content <> b.content""",
        "p6_canonical": f"""with {_CHUNKS}, f as (select chunk_id, content, md5({_look_alike("content")}) as form from chunks1), g as (select form, md5(min(content)) as canonical, count(distinct content) as n from f where content is not null group by 1)
select chunk_id, canonical as form, n as n_forms from f left join g using (form)""",
        "p7_found": rf"""with {_REQUIREMENTS}, v as (select *, regexp_replace(item_number, '^\s+|\s+$', '', 'g') as item, length(regexp_replace(description_en, '^\s+|\s+$', '', 'g')) as n from requirements1 where item_number is not null)
select source_file, item as item_number, arg_max(id, (n, updated_at, id)) filter (where n > 0) as description_id, arg_max(id, (updated_at, id)) filter (where confidence is not null) as confidence_id,
arg_max(id, (case confidence when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end, updated_at, id)) filter (where priority is not null) as priority_id from v group by 1, 2 having count(*) > 1""",
        "p7_first_rates": rf"""with {_REQUIREMENTS}, r as (select coalesce('=' || source_file, '') as tender, regexp_replace(item_number, '^\s+|\s+$', '', 'g') as item, coalesce(merge_record.rule, '?') || '/' || coalesce(source_language, '?') as origin, standards, referenced_annexes, id from requirements1 where item_number is not null),
m as (select * from r join (select tender, item from r group by 1, 2 having count(*) > 1) using (tender, item)), f as (select tender, item, origin, id, 'standards' as field, standards as vals from m where standards is not null union all select tender, item, origin, id, 'referenced_annexes', referenced_annexes from m where referenced_annexes is not null),
heard as (select tender, item, field, origin, count(*) as members from f group by 1, 2, 3, 4), said as (select tender, item, field, origin, value, count(distinct id) as pos from (select * exclude (vals), trim(unnest(vals)) as value from f) where value <> '' group by 1, 2, 3, 4, 5),
grid as (select v.tender, v.item, v.field, v.value, h.origin, coalesce(s.pos, 0) as pos, h.members - coalesce(s.pos, 0) as neg from (select distinct tender, item, field, value from said) v join heard h using (tender, item, field) left join said s on s.tender = v.tender and s.item = v.item and s.field = v.field and s.value = v.value and s.origin = h.origin),
g as (select *, sum(pos) over w / sum(pos + neg) over w as p from grid window w as (partition by tender, item, field, value))
select field, origin as source, round((sum(p * pos) + 4) / (sum(p * (pos + neg)) + 6), 9) as sensitivity, round(1 - (sum((1 - p) * pos) + 1) / (sum((1 - p) * (pos + neg)) + 10), 9) as specificity from g group by 1, 2""",
        "p8_longest": f"""with d as (select doc_id, {words.format(x="text")} as w from documents), i as (select item_id, {words.format(x="text")} as w from benchmark),
g as (select item_id, k, array_to_string(w[k:k + 11], ' ') as run from (select *, unnest(range(1, len(w) - 10)) as k from i where len(w) >= 12)), h as (select doc_id, k, array_to_string(w[k:k + 11], ' ') as run from (select *, unnest(range(1, len(w) - 10)) as k from d where len(w) >= 12)),
m as (select doc_id, item_id, h.k - g.k as diagonal, h.k - row_number() over (partition by doc_id, item_id, h.k - g.k order by h.k) as island from h join g using (run)), r as (select doc_id, item_id, count(*) + 11 as n from m group by doc_id, item_id, diagonal, island)
select doc_id, item_id, len(w)::int as item_words, max(n)::int as longest from r join i using (item_id) group by 1, 2, 3""",
        "p8_found": f"""with d as (select doc_id, {words.format(x="text")} as w from documents), i as (select item_id, {words.format(x="text")} as w from benchmark),
g as (select item_id, array_to_string(w[k:k + 11], ' ') as run from (select *, unnest(range(1, len(w) - 10)) as k from i where len(w) >= 12)), h as (select doc_id, array_to_string(w[k:k + 11], ' ') as run from (select *, unnest(range(1, len(w) - 10)) as k from d where len(w) >= 12))
select distinct doc_id, item_id from g join h using (run)""",
        "p10_paragraph_clusters": rf"""with recursive raw as (select doc_id, string_split(regexp_replace(text, '([.!?]{space}+|\n{space}*\n)', '\1' || chr(1), 'g'), chr(1)) as parts from documents where text is not null),
pos as (select doc_id, parts[i] as part, coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0)::int as begin from (select *, unnest(range(1, len(parts) + 1)) as i from raw)),
para as (select doc_id, begin, regexp_replace(part, '(?:([.!?]){space}+|\n{space}*\n)$', '\1') as text from pos), placed as (select * from para where not regexp_full_match(text, '{space}*')),
once as (select text, min((doc_id, begin)) as first, count(*) as copies, row_number() over (order by text) as pid from placed group by text),
sh as (select pid, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as grams from (select pid, list_filter(regexp_split_to_array(lower(text), '{space}+'), lambda x: x <> '') as w from once) where len(w) >= 5),
x as (select pid, len(grams) as n, unnest(grams) as g from sh), e as (select a.pid as a, b.pid as b from x a join x b on a.g = b.g and a.pid <> b.pid group by 1, 2, a.n, b.n having count(*) >= 0.8 * (a.n + b.n - count(*))),
r(pid, other) as (select pid, pid from once union select r.pid, e.b from r join e on e.a = r.other), c as (select pid, min(other) as root from r group by 1),
h as (select root, min(first) as head, sum(copies)::bigint as members from once join c using (pid) group by 1 having sum(copies) > 1)
select doc_id, begin, head[1] as cluster_doc, head[2] as cluster_begin, members, (doc_id, begin) <> head as removed from placed join once using (text) join c using (pid) join h using (root)""",
        "p10_found": """with w as (select doc_id, p, md5(text[p:p + 449]) as h from (select doc_id, text, unnest(range(1, length(text) - 448)) as p from documents where length(text) >= 450)),
s as (select h from w group by 1 having min(doc_id) <> max(doc_id)), m as (select doc_id, p, p - lag(p) over (partition by doc_id order by p) as gap from w join s using (h))
select doc_id, sum(case when gap is null then 450 else least(450, gap) end)::bigint as shared_chars from m group by 1""",
    }


SQL: dict[str, str] = _sql()
