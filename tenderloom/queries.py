"""The registered queries of the core operators, and the SQL each is compared with.

Every query runs over its whole tables. Chunks stand for the pages of their
tender: a page is (``source_file``, ``page_number``), its lines are those of its
chunks in order of ``seq``. Where SQL can't express an operator (folds,
connected components, ranked packing), the tests compare it with a brute-force
version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderloom.functions import text as T
from tenderloom.operators import consolidate as C
from tenderloom.operators import evaluate, extract, grounding, layout, link, nested, profile, segment, tree
from tenderloom.operators.latest import latest, latest_requirements
from tenderloom.plans import prompts
from tenderloom.runtime import table

REQUIREMENT = ["id", "source_file", "source_chunk_ids", "merge_record", "bullet_point", "description_en", "description_de", "priority", "equivalence_allowed", "confidence", "standards", "referenced_annexes", "category_code", "section_heading", "item_number", "source_language", "req_order"]
EXTRACTION = ["unit_key", "chunk_id", "source_file", "page_number", "section_heading", "bullet_point", "description_en", "description_de", "priority", "equivalence_allowed", "confidence", "standards", "referenced_annexes", "cross_referenced_positions", "category_code", "item_number", "source_language", "ext_ord"]
CHUNK = ["chunk_id", "source_file", "page_number", "section_heading", "lv_position", "document_region", "category_code", "content", "seq"]


# The tables, one row per key.
def chunks(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "chunks"), "chunk_id", ["loaded_at"], CHUNK)


def extractions(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "extractions"), "unit_key", ["loaded_at"], EXTRACTION)


def requirements(spark: SparkSession, d: str) -> DataFrame:
    return latest_requirements(table(spark, d, "requirements"), REQUIREMENT)


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with a font size: group headers and lines in capitals are set larger, lines of three digits or more at their end smaller."""
    rows = chunks(spark, d).select(F.col("source_file").alias("doc_id"), F.col("page_number").alias("page"), "seq", F.posexplode(F.split("content", "\n")).alias("pos", "text"))
    size = F.when(F.col("text").rlike("^[0-9]{2}[.][0-9]{2} [A-Z]"), 12.5).when(F.col("text").rlike("[0-9]{3}[.]?$"), 9.0).otherwise(10.0)
    return rows.select("doc_id", "page", ((F.col("seq").cast("long") * F.lit(1 << 31)) + F.col("pos")).alias("line_no"), "text", size.alias("font_size"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    rows = chunks(spark, d).groupBy(F.col("source_file").alias("doc_id"), F.col("page_number").alias("page")).agg(F.array_sort(F.collect_list(F.struct("seq", "chunk_id", "content"))).alias("c"))
    return rows.select("doc_id", "page", F.array_join("c.content", "\n").alias("text"))


ONCE = """chunks1 as (select * from (select *, row_number() over (partition by chunk_id order by loaded_at desc) as rn_ from chunks where chunk_id is not null) where rn_ = 1),
extractions1 as (select * from (select *, row_number() over (partition by unit_key order by loaded_at desc) as rn_ from extractions where unit_key is not null) where rn_ = 1),
requirements1 as (select * from (select *, row_number() over (partition by id order by updated_at desc, loaded_at desc) as rn_ from requirements where id is not null) where rn_ = 1),
lines1 as (select source_file as doc_id, page_number as page, seq::bigint * 2147483648 + pos - 1 as line_no, lines[pos] as text from (select *, unnest(range(1, len(lines) + 1)) as pos from (select source_file, page_number, seq, string_split(content, chr(10)) as lines from chunks1))),
pages1 as (select source_file as doc_id, page_number as page, string_agg(content, chr(10) order by seq, chunk_id) as text from chunks1 group by all)"""
WS_SQL = r"\t\n\x0b\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def trim_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^[{WS_SQL}]+|[{WS_SQL}]+$', '', 'g')"


def fold_sql(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '[{WS_SQL}]+', ' ', 'g'))"


def inline_sql(x: str) -> str:
    for a, b in T.LIGATURES:
        x = f"replace({x}, '{a}', '{b}')"
    return rf"regexp_replace(replace(replace(replace({x}, '–', '-'), '—', '-'), '„', '\"'), '[\x{{200B}}\x{{200C}}\x{{200D}}\x{{FEFF}}]', '', 'g')"


POSITION_SQL = r"coalesce(regexp_matches({x}, '^(?:\d{{2}}\.\d{{2}}\.\d{{3,5}}|[A-Z]{{2}}\.\d{{2}}\.\d{{2}}\.\d{{2}}\.\d{{2}}|00\.00\.00\.\d{{2}}\.\d{{2}})$'), false)"


def position_sql(x: str) -> str:
    return POSITION_SQL.format(x=x)


HAS_CATEGORY_SQL = "coalesce(category_code <> '', false)"
KEY_SQL = "coalesce(category_code, section_heading, 'general')"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its own name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"with {ONCE} {sql}"
        return f

    return add


# Nested records.
@query()
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.tree_links(table(spark, d, "deliverable_trees"))


@query()
def p4_nodes(spark: SparkSession, d: str) -> DataFrame:
    return nested.tree_nodes(table(spark, d, "deliverable_trees"))


@query()
def p4_subtrees(spark: SparkSession, d: str) -> DataFrame:
    return nested.subtree_sizes(nested.tree_nodes(table(spark, d, "deliverable_trees")))


# Profiling.
@query(f"select chunk_id, md5({inline_sql('content')}) as digest from chunks1")
def normalize_inline(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("chunk_id", F.md5(T.normalize_inline("content")).alias("digest"))


_COUNTS = r"len(regexp_extract_all(text, '\d{2}\.\d{2}\.\d{3,5}')) + len(regexp_extract_all(text, '[A-Z]{2}\.\d{2}\.\d{2}\.\d{2}\.\d{2}'))"
_PRE = r"len(regexp_extract_all(text, '00\.00\.00\.\d{2}\.\d{2}'))"


@query(
    rf""", p as (select doc_id, length(text) as chars, length(text) - length(translate(text, 'ﬀﬁﬂﬃﬄﬅﬆ', '')) as lig,
regexp_matches(text, 'EUR[{WS_SQL}]+(?:PP|EP|SO|ST)[{WS_SQL}]+EUR') as noise, {_COUNTS} as pos, {_PRE} as pre from pages1),
q as (select doc_id, count(*) as page_count, sum(chars) as chars, sum(lig) as lig, bool_or(noise) as column_noise, sum(pos)::bigint as positions, sum(pre)::bigint as preambles, count_if(pre > 0)::bigint as preamble_pages from p group by 1)
select doc_id, page_count, round(chars / page_count, 6) as avg_chars, round(lig / chars, 9) as ligature_rate, column_noise, positions, preambles, preamble_pages,
case when positions > 5 and preambles > 10 then 'mixed' when preambles > 10 then 'vorbemerkungen-heavy' when positions > 5 then 'lv-position' else 'section-list' end as strategy,
case when lig / chars > 0.01 then 'low' when column_noise then 'medium' else 'high' end as parser_confidence from q"""
)
def profile_quality(spark: SparkSession, d: str) -> DataFrame:
    return profile.profile(pages(spark, d))


@query(rf"select doc_id, page, ({_COUNTS})::int as positions, ({_PRE})::int as preambles from pages1")
def code_counts(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("doc_id", "page", T.count_positions("text").alias("positions"), T.count_preambles("text").alias("preambles"))


@query(
    """, p as (select doc_id, page, max(page) over (partition by doc_id) as n from pages1), s as (select *, least(60, greatest(30, floor(n * 0.1)))::int as size from p)
select doc_id, page from s where n <= size or page <= 5 or page > n - 5 or (page >= 6 and (page - 6) % greatest(1, floor((n - 10) / (size - 10)))::int = 0 and page < 6 + (size - 10) * greatest(1, floor((n - 10) / (size - 10)))::int)"""
)
def page_sample(spark: SparkSession, d: str) -> DataFrame:
    return profile.page_sample(pages(spark, d).select("doc_id", "page"))


@query(
    f""", l as (select distinct doc_id, page, {trim_sql('text')} as line from lines1), n as (select doc_id, count(*) as pages from pages1 group by 1)
select doc_id, line, n_pages from (select doc_id, line, count(*) as n_pages from l where length(line) > 3 group by 1, 2) join n using (doc_id) where n_pages >= 0.02 * pages and n_pages > 0"""
)
def running_headers(spark: SparkSession, d: str) -> DataFrame:
    return profile.running_headers(pages(spark, d), profile.Profiling(repeated_share=0.02))


# Layout and segmentation.
_LINE = f"select doc_id, page, line_no, {trim_sql(inline_sql('text'))} as t, case when regexp_matches(text, '^[0-9]{{2}}[.][0-9]{{2}} [A-Z]') then 12.5 when regexp_matches(text, '[0-9]{{3}}[.]?$') then 9.0 else 10.0 end::double as font_size from lines1"
_REPEATED = rf"""l as ({_LINE}), n as (select doc_id, count(distinct page) as pages from l group by 1),
k as (select distinct doc_id, page, regexp_replace(t, '\d+', '#', 'g') as key from l where length(t) >= 4),
rep as (select doc_id, key, n_pages from (select doc_id, key, count(*) as n_pages from k group by 1, 2) join n using (doc_id) where n_pages >= greatest(2, ceil(pages * 0.02)))"""


@query(f", {_REPEATED} select doc_id, key, n_pages from rep")
def repeated_line_keys(spark: SparkSession, d: str) -> DataFrame:
    return segment.repeated_keys(lines(spark, d), 0.02)


@query(rf", {_REPEATED} select doc_id, page, line_no, t as text from l where t <> '' and not exists (select 1 from rep where rep.doc_id = l.doc_id and rep.key = regexp_replace(l.t, '\d+', '#', 'g'))")
def repeated_line_filter(spark: SparkSession, d: str) -> DataFrame:
    return segment.kept_lines(lines(spark, d), 0.02).select("doc_id", "page", "line_no", "text")


@query(f", l as ({_LINE}), c as (select doc_id, font_size as body, count(*) as n, min((page, line_no)) as first from l group by 1, 2) select doc_id, body from (select *, row_number() over (partition by doc_id order by n desc, first) as r from c) where r = 1")
def body_size(spark: SparkSession, d: str) -> DataFrame:
    return segment.body_size(lines(spark, d))


_UP = r"(length(t) between 4 and 60 and not regexp_matches(t, '[.,:;]$') and length(regexp_replace(t, '[^\p{L}]', '', 'g')) >= 3 and not regexp_matches(t, '[\p{Ll}\p{Lt}]'))"
_CODES = rf"""case when regexp_matches(t, '^00\.00\.00\.\d{{2}}\.\d{{2}}(?:[{WS_SQL}]|$)') then 1 when regexp_matches(t, '^[A-Z]{{2}}(?:\.\d{{2}}){{4}}(?:[{WS_SQL}]|$)') then 2 when regexp_matches(t, '^\d{{2}}\.\d{{2}}\.\d{{3,5}}(?:[{WS_SQL}]|$)') then 3 end"""
_KINDS = rf"""l as ({_LINE}), b as (select doc_id, font_size as body from (select *, row_number() over (partition by doc_id order by n desc, first) as r from (select doc_id, font_size, count(*) as n, min((page, line_no)) as first from l group by 1, 2)) where r = 1),
m as (select *, (font_size >= body * 1.2 or {_UP} or regexp_matches(t, '^\d{{2}}(?:\.\d{{2}})?[{WS_SQL}]+\p{{Lu}}[\p{{L}} ./&-]{{2,}}$')) as heading from l join b using (doc_id) where t <> ''),
c as (select *, case when not heading then {_CODES} end as fam, regexp_extract(t, '^[^{WS_SQL}]+') as lead from m),
k as (select *, case when heading then null when fam is not null then lead else nullif(regexp_replace(regexp_extract(t, '^(\d{{1,3}}(?:\.\d{{1,3}})+|\d{{1,3}}[.)]|[A-Za-z][.)]|[•·*])[{WS_SQL}]+[^{WS_SQL}]', 1), '[.)]+$', ''), '') end as label from c),
labelled as (select doc_id, page, line_no, t as text, label, case when heading then 'heading' when label is not null then 'item' else 'body' end as kind, case fam when 1 then 'vorbemerkungen' when 2 then 'lv-position' when 3 then 'lv-position' end as region,
case when fam > 1 then lead end as lv_position, case fam when 1 then nullif(string_split(lead, '.')[4], '00') when 2 then string_split(lead, '.')[3] end as category_code from k)"""


@query(f", {_KINDS} select * from labelled")
def line_labels(spark: SparkSession, d: str) -> DataFrame:
    kept = lines(spark, d).withColumn("text", T.trim(T.normalize_inline("text"))).filter("text <> ''")
    return segment.classified(kept).select("doc_id", "page", "line_no", "text", "label", "kind", F.col("code.region").alias("region"), F.col("code.lv_position").alias("lv_position"), F.col("code.category_code").alias("category_code"))


_SEGMENTS = (
    rf"""{_KINDS}, {_REPEATED.replace('l as (' + _LINE + '), ', '').replace('n as', 'n2 as').replace('join n using', 'join n2 using').replace('k as (', 'k2 as (').replace('from k group', 'from k2 group').replace('0.02', '0.6')},
x as (select * from labelled where not exists (select 1 from rep where rep.doc_id = labelled.doc_id and rep.key = regexp_replace(labelled.text, '\d+', '#', 'g'))),
w as (select *, sum((kind <> 'body')::int) over (partition by doc_id order by page, line_no) as segment, last_value(case when kind = 'heading' then text end ignore nulls) over (partition by doc_id order by page, line_no rows between unbounded preceding and current row) as h from x),
g as (select doc_id, segment, arg_min(h, (page, line_no)) as h, bool_or(kind = 'item') as own, max(case when kind = 'item' then label end) as label, max(case when kind = 'item' then region end) as region, max(lv_position) as lv_position, max(category_code) as category_code,
min(case when kind = 'body' then page end) as body_page, min(page) as first_page, string_agg(text, chr(10) order by page, line_no) filter (where kind <> 'heading') as body from w group by 1, 2),
segs as (select doc_id, segment::bigint as segment, case when own then first_page else body_page end as page, coalesce(h, 'General Requirements') as heading, case when own then label else 'sec' end as label, coalesce(region, 'section') as region, lv_position, category_code,
{trim_sql("case when own then body else coalesce(h, 'General Requirements') || chr(10) || body end")} as content from g where own or body_page is not null)"""
)


@query(f", {_SEGMENTS} select * exclude (content), md5(content) as digest from segs")
def segments(spark: SparkSession, d: str) -> DataFrame:
    return segment.segments(lines(spark, d)).withColumn("digest", F.md5("content")).drop("content")


_LIVE = r"""not exists (select 1 from (select unnest(string_split(content, chr(10))) as x) where regexp_matches(trim(x),
'(?i)^(?:[A-Za-z]{0,3}[\d.]{2,}\s+)?[\s"''.\-–—„“”]*(?:entf[äa]llt|not applicable|n/a|cancelled|voided|omitted|sans objet|supprim|soppress|annull|anulad)[\s"''.!\-–—„“”]*$'))"""
#: A text over 3,000 tokens as parts: lines are added to the open part while it fits.
_BUDGET = """case when ceil(length({x}) / 4) > 3000 then (with_open(list_reduce(list_transform(string_split({x}, chr(10)), lambda l: {{'parts': []::varchar[], 'open': l}}),
lambda a, y: case when ceil(length(a.open || chr(10) || y.open) / 4) > 3000 then {{'parts': a.parts || [a.open], 'open': y.open}} else {{'parts': a.parts, 'open': a.open || chr(10) || y.open}} end))) else [{x}] end"""
_BUDGET = _BUDGET.replace("with_open(", "list_transform([").replace("end))) else", "end)], lambda r: r.parts || [r.open]))[1] else")


@query(
    f""", {_SEGMENTS}, live as (select * from segs where content <> '' and {_LIVE}), cut as (select *, {_BUDGET.format(x='content')} as pieces from live), p as (select * exclude (pieces), unnest(pieces) as piece, unnest(range(len(pieces))) as part from cut),
n as (select *, row_number() over (partition by doc_id order by page, segment, part) - 1 as seq from p where {trim_sql('piece')} <> '')
select regexp_replace(lower(regexp_replace(doc_id, '\\.pdf$', '')), '[^a-z0-9]+', '-', 'g') || '__' || region || '_' || regexp_replace(label, '[^a-zA-Z0-9]+', '_', 'g') || '__i' || seq as chunk_id, doc_id as source_file, page as page_number, heading as section_heading, lv_position, region as document_region, category_code, seq::int as seq, md5(piece) as digest from n"""
)
def chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    return segment.chunks(segment.segments(lines(spark, d))).withColumn("digest", F.md5("content")).drop("content")


@query(f"select chunk_id from chunks1 where {_LIVE}")
def cancelled_filter(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).filter(~T.is_cancelled("content")).select("chunk_id")


@query(f"select chunk_id, (i - 1)::int as part, length(pieces[i]) as n_chars, md5(pieces[i]) as digest from (select chunk_id, pieces, unnest(range(1, len(pieces) + 1)) as i from (select chunk_id, {_BUDGET.format(x='content')} as pieces from chunks1))")
def budget_split(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("chunk_id", F.posexplode(segment.split_to_budget(F.col("content"))).alias("part", "piece")).select("chunk_id", "part", F.length("piece").cast("long").alias("n_chars"), F.md5("piece").alias("digest"))


@query(
    rf""", w as (select doc_id::varchar as doc_id, unnest(parts) as str, unnest(range(len(parts))) as ord from (select doc_id, regexp_split_to_array(text, '[\t\n\x0b\f\r ]+') as parts from documents where doc_id is not null)),
gl as (select doc_id, floor(floor(ord / 6) / 40)::int as page, ord, str, (ord % 6) * 80.0::double as x, 700.0::double - (floor(ord / 6) % 40) * 12 - (ord % 6 % 3) * 2 as y, length(str) * 5.0::double as width, case when length(str) > 12 then 12.0 else 10.0 end::double as size from w where str <> ''),
tol as (select doc_id, page, list_sort(list(size))[(count(*) // 2)::int + 1] * 0.5 as tol from gl group by 1, 2),
fold as (select doc_id, page, list_reduce(list({{'first': y, 'band': 0, 'bands': [{{'ord': ord, 'band': 0}}], 'tol': tol}} order by y desc, x, ord), lambda a, g: case when abs(g.first - a.first) > g.tol then {{'first': g.first, 'band': a.band + 1, 'bands': a.bands || [{{'ord': g.bands[1].ord, 'band': a.band + 1}}], 'tol': g.tol}} else {{'first': a.first, 'band': a.band, 'bands': a.bands || [{{'ord': g.bands[1].ord, 'band': a.band}}], 'tol': g.tol}} end).bands as bands from gl join tol using (doc_id, page) group by 1, 2),
b as (select doc_id, page, unnest(bands).ord as ord, unnest(bands).band as line_no from fold), z as (select *, x - lag(x + width) over (partition by doc_id, page, line_no order by x, ord) > size * 0.25 as gap from gl join b using (doc_id, page, ord))
select doc_id, page, line_no, md5(trim(regexp_replace(string_agg(case when gap then ' ' || str else str end, '' order by x, ord), '[{WS_SQL}]+', ' ', 'g'))) as text, arg_min(x, (x, ord)) as x, max(y) as y, arg_max(x + width, (x, ord)) - arg_min(x, (x, ord)) as width, max(size) as font_size from z group by 1, 2, 3"""
)
def glyph_lines(spark: SparkSession, d: str) -> DataFrame:
    return layout.lines(layout.glyphs(text_items(spark, d))).withColumn("text", F.md5("text"))


def text_items(spark: SparkSession, d: str) -> DataFrame:
    """The words of documents as text items, six a row, rows uneven in height; every size is given by the height where the transform has none."""
    w = table(spark, d, "documents").filter("doc_id is not null").select("doc_id", F.posexplode(F.split("text", r"\s+")).alias("ord", "str"))
    row, col = F.floor(F.col("ord") / 6), F.col("ord") % 6
    size = F.when(F.length("str") > 12, 12.0).otherwise(10.0)
    x, y = (col * 80.0), (700.0 - (row % 40) * 12 - (col % 3) * 2)
    given = F.when(F.col("ord") % 2 == 0, size).otherwise(0.0)
    return w.select(F.col("doc_id").cast("string").alias("doc_id"), F.floor(row / 40).cast("int").alias("page"), "ord", "str", F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), given, x.cast("double"), y.cast("double")).alias("transform"), (F.length("str") * 5.0).alias("width"), size.alias("height"), (col == 5).alias("has_eol"))


@query(
    rf""", w as (select doc_id::varchar as doc_id, unnest(parts) as str, unnest(range(len(parts))) as ord from (select doc_id, regexp_split_to_array(text, '[\t\n\x0b\f\r ]+') as parts from documents where doc_id is not null))
select doc_id, floor(floor(ord / 6) / 40)::int as page, md5(regexp_replace(string_agg(str || case when ord % 6 = 5 then chr(10) else ' ' end, '' order by ord), '[{WS_SQL}]+$', '')) as digest from w group by 1, 2"""
)
def page_texts(spark: SparkSession, d: str) -> DataFrame:
    return profile.page_text(text_items(spark, d)).select("doc_id", "page", F.md5("text").alias("digest"))


_HEADERS = f"""tl as (select distinct doc_id, page, {trim_sql('text')} as line from lines1), np as (select doc_id, count(*) as pages from pages1 group by 1),
hd as (select doc_id, list(line order by line) as headers from (select doc_id, line, count(*) as n_pages from tl where length(line) > 3 group by 1, 2) join np using (doc_id) where n_pages >= 0.02 * pages group by 1)"""


@query(
    rf""", {_HEADERS}, st as (select doc_id, page, list_reduce([{inline_sql('text')}] || coalesce(headers, []), lambda t, h: replace(t, h, '')) as t from pages1 left join hd using (doc_id))
select doc_id, page, md5({trim_sql(rf"regexp_replace(regexp_replace(t, 'EUR[{WS_SQL}]+(?:PP|EP|SO|ST)[{WS_SQL}]+EUR', '', 'g'), '([^A-Za-z0-9_]|^)[0-9]+[.][0-9]+[{WS_SQL}]+LO([^A-Za-z0-9_]|$)', '\1\2', 'g')")}) as digest from st"""
)
def normalized_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages without the lines that many pages of their document have, and without stranded price labels."""
    p = pages(spark, d)
    headers = profile.running_headers(p, profile.Profiling(repeated_share=0.02)).groupBy("doc_id").agg(F.array_sort(F.collect_list("line")).alias("headers"))
    rows = p.join(headers, "doc_id", "left")
    return rows.select("doc_id", "page", F.md5(T.normalize_page("text", F.coalesce("headers", F.array().cast("array<string>")), True)).alias("digest"))


@query(
    rf""", l as (select doc_id, page, line_no, {trim_sql(inline_sql("case when line_no % 3 = 0 then 'EUR' || repeat(' PP', (line_no % 4)::int) else text end"))} as t from lines1)
select doc_id, page, line_no, t as text from l where t <> '' and not regexp_matches(t, '^(?:EUR|PP|EP|SO|ST|LO|LM)(?:[{WS_SQL}]+(?:EUR|PP|EP|SO|ST|LO|LM))*$')"""
)
def column_noise_filter(spark: SparkSession, d: str) -> DataFrame:
    """Every third line is set to price column labels, all documents are said to have such; no line repeats on half of the pages or is dropped for it."""
    made = lines(spark, d).withColumn("text", F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("EUR"), F.repeat(F.lit(" PP"), (F.col("line_no") % 4).cast("int")))).otherwise(F.col("text")))
    return segment.kept_lines(made.withColumn("strip_noise", F.lit(True)), 9.0).select("doc_id", "page", "line_no", "text")


# Extraction.
_RAW = """select unit_key, case ext_ord % 7 when 1 then 'equivalence' when 2 then 'title' when 3 then 'priority' when 4 then 'lists' when 5 then 'broken' else 'none' end as fault from extractions1"""


def raw_items(spark: SparkSession, d: str) -> DataFrame:
    """Extractions as JSON items, every seventh of each kind with a fault: a missing key, a short title, an unknown priority, a null list, broken text."""
    e = extractions(spark, d)
    n = F.col("ext_ord") % 7
    title, prio = F.when(n == 2, F.lit("ab")).otherwise(F.col("bullet_point")), F.when(n == 3, F.lit("urgent")).otherwise(F.col("priority"))
    item = F.struct(title.alias("bullet_point"), "description_en", "description_de", prio.alias("priority"), "confidence", F.when(n == 4, F.lit(None)).otherwise(F.col("standards")).alias("standards"), "referenced_annexes", "category_code", "item_number", "source_language", "equivalence_allowed")
    text = F.to_json(item, {"ignoreNullFields": "false"})
    text = F.when(n == 1, F.regexp_replace(text, r',"equivalence_allowed":(?:null|true|false)\}$', "}")).when(n == 5, F.substring(text, 1, 40)).otherwise(text)
    return e.select("chunk_id", F.col("ext_ord").alias("item_ord"), text.alias("item_json"))


@query(
    f""", r as ({_RAW}) select e.chunk_id, e.ext_ord as item_ord, e.source_file, coalesce(c.category_code, e.category_code) as category_code, coalesce(c.lv_position, e.item_number) as item_number, nullif(lower(e.source_language)[1:2], '') as source_language, e.priority, c.page_number
from extractions1 e join r using (unit_key) join chunks1 c using (chunk_id) where fault = 'none' and length(bullet_point) >= 3 and length(description_en) >= 5 and priority in ('must', 'should', 'optional') and confidence in ('high', 'medium', 'low') and standards is not null and referenced_annexes is not null"""
)
def json_validate(spark: SparkSession, d: str) -> DataFrame:
    out = extract.enriched(extract.validated(raw_items(spark, d)), chunks(spark, d))
    return out.select("chunk_id", "item_ord", "source_file", "category_code", "item_number", "source_language", "priority", "page_number")


@query("select chunk_id, source_file from chunks1 where chunk_id not in (select chunk_id from extractions where chunk_id is not null)")
def cache_miss_anti(spark: SparkSession, d: str) -> DataFrame:
    return extract.cache_misses(chunks(spark, d), table(spark, d, "extractions")).select("chunk_id", "source_file")


@query("select chunk_id from chunks1 where document_region <> 'lv-position' and chunk_id in (select chunk_id from extractions)")
def glean_candidates(spark: SparkSession, d: str) -> DataFrame:
    return extract.glean_candidates(chunks(spark, d), table(spark, d, "extractions")).select("chunk_id")


@query(
    f""", f as (select * from extractions1 where ext_ord % 2 = 0), g as (select * from extractions1 where ext_ord % 2 = 1)
select unit_key, chunk_id from f union all select unit_key, chunk_id from g where not exists (select 1 from f where f.chunk_id = g.chunk_id and lower({trim_sql('f.bullet_point')}) = lower({trim_sql('g.bullet_point')}))"""
)
def glean_both_passes(spark: SparkSession, d: str) -> DataFrame:
    e = extractions(spark, d).select("unit_key", "chunk_id", "bullet_point", "ext_ord")
    return extract.both_passes(e.filter("ext_ord % 2 = 0"), e.filter("ext_ord % 2 = 1")).select("unit_key", "chunk_id")


@query(
    """select chunk_id, md5(concat_ws(chr(10), 'Document region: ' || nullif(document_region, ''), 'LV position: ' || nullif(lv_position, ''), 'Category code: ' || nullif(category_code, ''), 'Section heading: ' || nullif(section_heading, ''), content)) as digest from chunks1"""
)
def user_messages(spark: SparkSession, d: str) -> DataFrame:
    c = chunks(spark, d)
    return c.select("chunk_id", F.md5(extract.user_message(*[F.col(x) for x in ("document_region", "lv_position", "category_code", "section_heading", "content")])).alias("digest"))


@query(
    rf""", h as (select chunk_id, content, string_split(content, chr(10)) as l, regexp_split_to_array(content, '[{WS_SQL}]+') as w from chunks1 where ceil(length(content) / 4) > 3000),
t as (select chunk_id, case when len(l) > 1 then [array_to_string(l[1:ceil(len(l) / 2)::int], chr(10)), array_to_string(l[ceil(len(l) / 2)::int + 1:], chr(10))] when len(w) > 1 then [array_to_string(w[1:ceil(len(w) / 2)::int], ' '), array_to_string(w[ceil(len(w) / 2)::int + 1:], ' ')]
else [content[1:ceil(length(content) / 2)::int], content[ceil(length(content) / 2)::int + 1:]] end as halves from h)
select chunk_id, (i - 1)::int as half, length(halves[i]) as n_chars from (select *, unnest([1, 2]) as i from t)"""
)
def content_halves(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).filter(T.token_estimate("content") > 3000).select("chunk_id", F.posexplode(extract.halves(F.col("content"))).alias("half", "text")).select("chunk_id", "half", F.length("text").cast("long").alias("n_chars"))


_REGIONS = "case document_region when 'lv-position' then '{}' when 'vorbemerkungen' then '{}' else '{}' end".format(*[prompts.REGIONS[r].replace("'", "''") for r in ("lv-position", "vorbemerkungen", "section")])


@query("select chunk_id, md5('" + (prompts.EXTRACT + "\n\nThe block: ").replace("'", "''") + f"' || {_REGIONS}) as digest from chunks1")
def system_prompts(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("chunk_id", F.md5(prompts.by_region(prompts.EXTRACT, F.col("document_region"))).alias("digest"))


# Consolidation.
@query("select source_file, chunk_id, ext_ord, chunk_id || '#' || (row_number() over (partition by source_file, chunk_id order by ext_ord) - 1) as unit_key from extractions1")
def unit_keys(spark: SparkSession, d: str) -> DataFrame:
    return C.units(extractions(spark, d)).select("source_file", "chunk_id", "ext_ord", "unit_key")


_UNITS = f"""u as (select * exclude (unit_key, rn_), chunk_id || '#' || (row_number() over (partition by source_file, chunk_id order by ext_ord) - 1) as unit_key from extractions1),
sp as (select * from u where {HAS_CATEGORY_SQL} and not {position_sql('item_number')}), pl as (select source_file, category_code, chunk_id, min(ext_ord) as o from u where {HAS_CATEGORY_SQL} and {position_sql('item_number')} group by 1, 2, 3),
used as (select distinct source_file, chunk_id from pl where exists (select 1 from sp where sp.source_file = pl.source_file and sp.category_code = pl.category_code)),
rest as (select * from u where not ({HAS_CATEGORY_SQL} and not {position_sql('item_number')}) and not exists (select 1 from used where used.source_file = u.source_file and used.chunk_id = u.chunk_id))"""


@query(
    f""", {_UNITS}, l as (select source_file, category_code, list(chunk_id order by o, chunk_id) as placements from pl group by 1, 2)
select sp.source_file, sp.unit_key, sp.category_code, array_to_string([chunk_id] || list_filter(coalesce(placements, []), lambda x: x <> chunk_id), ' ') as sources from sp left join l on l.source_file = sp.source_file and l.category_code = sp.category_code"""
)
def category_placements(spark: SparkSession, d: str) -> DataFrame:
    return C.category_sources(C.units(extractions(spark, d))).select("source_file", "unit_key", "category_code", F.array_join("source_chunk_ids", " ").alias("sources"))


@query(f", {_UNITS} select source_file, unit_key from rest")
def consumed_anti(spark: SparkSession, d: str) -> DataFrame:
    return C.remaining(C.units(extractions(spark, d))).select("source_file", "unit_key")


@query(
    f""", {_UNITS} select source_file, unit_key, 'a|' || item_number as key from rest where {position_sql('item_number')}
union all select source_file, unit_key, 'b|' || {fold_sql('bullet_point')} || '|' || coalesce(section_heading, category_code, '') from rest where not {position_sql('item_number')} and bullet_point is not null
union all select source_file, unit_key, 'c|' || category_code || '|' || {fold_sql('description_en')} from rest where {HAS_CATEGORY_SQL} and description_en is not null"""
)
def identity_keys(spark: SparkSession, d: str) -> DataFrame:
    return C.identity_keys(C.remaining(C.units(extractions(spark, d))))


_IDENTITY = f"""k as (select source_file, unit_key, 'a|' || item_number as key from rest where {position_sql('item_number')}
union all select source_file, unit_key, 'b|' || {fold_sql('bullet_point')} || '|' || coalesce(section_heading, category_code, '') from rest where not {position_sql('item_number')} and bullet_point is not null
union all select source_file, unit_key, 'c|' || category_code || '|' || {fold_sql('description_en')} from rest where {HAS_CATEGORY_SQL} and description_en is not null),
m as (select source_file, key, min(unit_key) as low from k group by 1, 2), e as (select distinct source_file, unit_key as a, low as b from k join m using (source_file, key)), e2 as (select * from e union select source_file, b, a from e),
r(source_file, unit_key, other) as (select source_file, unit_key, unit_key from rest union select r.source_file, r.unit_key, e2.b from r join e2 on e2.source_file = r.source_file and e2.a = r.other),
grouped as (select source_file, unit_key, min(other) as id from r group by 1, 2)"""


def _recursive(name: str, sql: str) -> None:
    SQL[name] = f"with recursive {ONCE} {sql}"


_recursive("identity_components", f", {_UNITS}, {_IDENTITY} select * from grouped")


@query()
def identity_components(spark: SparkSession, d: str) -> DataFrame:
    return C.identity_groups(C.remaining(C.units(extractions(spark, d))))


def _joined(x: str) -> str:
    """Texts of an ordered list joined without restatements."""
    told = f"list_filter({x}, lambda t: t is not null and {fold_sql('t')} <> '')"
    return rf"""(case when len({told}) > 0 then array_to_string(list_reduce(
list_transform({told}, lambda t: {{'parts': [{trim_sql('t')}], 'seen': [{fold_sql('t')}], 'words': list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda w: length(w) > 3), 'numbers': list_transform(regexp_extract_all(t, '\d[\d.,]*'), lambda n: regexp_replace(n, '[.,]', '', 'g'))}}),
lambda a, y: case when list_contains(a.seen, y.seen[1]) or (len(list_filter(y.words, lambda w: list_contains(a.words, w))) >= 0.85 * len(y.words) and len(list_filter(y.numbers, lambda n: not list_contains(a.numbers, n))) = 0) then a
else {{'parts': a.parts || y.parts, 'seen': a.seen || y.seen, 'words': a.words || y.words, 'numbers': a.numbers || y.numbers}} end).parts, chr(10) || chr(10)) end)"""


_STRONG = "case {x} when 'must' then 3 when 'should' then 2 when 'optional' then 1 end"
_SURE = "case {x} when 'high' then 3 when 'medium' then 2 when 'low' then 1 end"
_STRONGEST = f"case max({_STRONG.format(x='priority')}) when 3 then 'must' when 2 then 'should' else 'optional' end"
#: Body fields of the fullest unit, as of rows ``all_`` (source_file, id, ...).
_REP = f"arg_max({{{{'c': confidence, 'i': item_number, 'e': equivalence_allowed, 's': section_heading, 'd': description_en, 'u': unit_key}}}}, {{{{'l': length(description_en), 'r': coalesce({_SURE.format(x='confidence')}, 0), 'o': -ext_ord}}}})".replace("{{", "{").replace("}}", "}")

_recursive(
    "consolidated",
    f""", {_UNITS}, {_IDENTITY}, cl as (select source_file, category_code, list(chunk_id order by o, chunk_id) as placements from pl group by 1, 2),
all_ as (select g.id, false as spec, rest.* from rest join grouped g using (source_file, unit_key) union all select unit_key, true, sp.* from sp),
refs as (select source_file, id, position from (select source_file, id, unnest(cross_referenced_positions) as position from all_) group by all),
src as (select source_file, id, list(chunk_id order by o) as chunk_ids from (select source_file, id, chunk_id, min((ext_ord, unit_key)) as o from all_ group by 1, 2, 3) group by 1, 2),
q as (select source_file, id, bool_or(spec) as spec, count(*) as n, count_if({position_sql('item_number')}) as n_pos, min(item_number) = max(item_number) and count(item_number) = count(*) as one_number, {_REP} as rep, arg_min(bullet_point, (ext_ord, unit_key)) as bullet_point, {_STRONGEST} as priority, min(ext_ord) as req_order, min(category_code) as category_code, list(description_en order by ext_ord, unit_key) as texts from all_ group by 1, 2),
o as (select q.*, case when spec then list_distinct_(chunk_ids, cl.placements) else chunk_ids end as sources from q join src using (source_file, id) left join cl on cl.source_file = q.source_file and cl.category_code = q.category_code and q.spec),
tg as (select source_file, rep.i as position, arg_max(id, (req_order, id)) as target from o where {position_sql('rep.i')} group by 1, 2), x as (select refs.source_file, refs.id, count(*) as n_refs from refs join tg on tg.source_file = refs.source_file and tg.position = refs.position where target <> refs.id group by 1, 2)
select o.source_file, o.id, array_to_string(sources, ' ') as sources, case when spec then 'vorbemerkungen-category' when n = 1 then 'standalone' when n_pos > 0 and one_number then 'lv-position-match' else 'staging-dedup' end as rule, (len(sources) + coalesce(n_refs, 0))::int as n_evidence,
bullet_point, md5(coalesce({_joined('texts')}, rep.d)) as digest, priority, rep.c as confidence, rep.i as item_number, req_order from o left join x on x.source_file = o.source_file and x.id = o.id""".replace("list_distinct_(chunk_ids, cl.placements)", "chunk_ids || list_filter(coalesce(cl.placements, []), lambda c: c <> chunk_ids[1])"),
)


@query()
def consolidated(spark: SparkSession, d: str) -> DataFrame:
    out = C.consolidate(extractions(spark, d))
    return out.select("source_file", "id", F.array_join("source_chunk_ids", " ").alias("sources"), "merge_record.rule", F.size("merge_record.evidence_links").alias("n_evidence"), "bullet_point", F.md5("description_en").alias("digest"), "priority", "confidence", "item_number", "req_order")


def _by_position(spark: SparkSession, d: str) -> DataFrame:
    """The position units of each tender merged by their code, without the other keys."""
    rows = C.units(extractions(spark, d)).filter(T.is_position("item_number"))
    return C.merged(rows, rows.select("source_file", "unit_key", F.col("item_number").alias("id")))


_POS = f"pos as (select * from extractions1 where {position_sql('item_number')})"


@query(f", {_POS}, q as (select source_file, item_number as id, {_REP} as rep, arg_min(bullet_point, (ext_ord, unit_key)) as bullet_point, {_STRONGEST} as priority, count(*) as n from pos group by 1, 2) select source_file, id, bullet_point, priority, rep.c as confidence, rep.e as equivalence_allowed, rep.s as section_heading, case when n = 1 then 'standalone' else 'lv-position-match' end as rule from q")
def merge_representative(spark: SparkSession, d: str) -> DataFrame:
    return _by_position(spark, d).select("source_file", "id", "bullet_point", "priority", "confidence", "equivalence_allowed", "section_heading", "merge_record.rule")


@query(
    f""", {_POS}, x as (select source_file, item_number as id, v, min((ext_ord, i)) as o from (select source_file, item_number, ext_ord, unnest(standards) as v, unnest(range(len(standards))) as i from pos) group by 1, 2, 3),
y as (select source_file, item_number as id, chunk_id, min((ext_ord, unit_key)) as o from pos group by 1, 2, 3), a as (select source_file, id, string_agg(v, '|' order by o) as standards from x group by 1, 2), b as (select source_file, id, string_agg(chunk_id, ' ' order by o) as sources from y group by 1, 2)
select source_file, id, coalesce(standards, '') as standards, sources from b left join a using (source_file, id)"""
)
def merge_arrays(spark: SparkSession, d: str) -> DataFrame:
    return _by_position(spark, d).select("source_file", "id", F.array_join("standards", "|").alias("standards"), F.array_join("source_chunk_ids", " ").alias("sources"))


@query(f", {_POS}, q as (select source_file, item_number as id, list(description_en order by ext_ord, unit_key) as en, list(description_de order by ext_ord, unit_key) as de from pos group by 1, 2) select source_file, id, md5({_joined('en')}) as en, md5({_joined('de')}) as de from q")
def join_descriptions(spark: SparkSession, d: str) -> DataFrame:
    return _by_position(spark, d).select("source_file", "id", F.md5("description_en").alias("en"), F.md5("description_de").alias("de"))


@query(
    f""", r as (select source_file, chunk_id, unit_key, ext_ord, item_number, cross_referenced_positions as refs from extractions1),
t as (select source_file, item_number as position, arg_max(unit_key, (ext_ord, unit_key)) as target_id, arg_max(chunk_id, (ext_ord, unit_key)) as chunk_id from r where {position_sql('item_number')} group by 1, 2)
select r.source_file, r.unit_key as id, t.position, t.target_id, t.chunk_id from (select distinct source_file, unit_key, unnest(refs) as position from r) r join t using (source_file, position) where t.target_id <> r.unit_key"""
)
def crossref_links(spark: SparkSession, d: str) -> DataFrame:
    r = extractions(spark, d).select("source_file", F.col("unit_key").alias("id"), F.col("ext_ord").alias("req_order"), "item_number", F.array("chunk_id").alias("source_chunk_ids"), F.col("cross_referenced_positions").alias("cross_references"))
    return C.cross_references(r).drop("ref_no")


# Linking.
_TOK = r"list_filter(list_distinct(regexp_split_to_array(lower(concat_ws(' ', bullet_point, description_en)), '[^\p{L}\p{N}]+')), lambda w: length(w) > 2)"
_CAND = f"""q as (select *, count(*) over (partition by source_file) as n from requirements1),
b as (select source_file, case when n <= 300 then '*' else '=' || {KEY_SQL} end as block, id, req_order, {position_sql('item_number')} as is_pos, {_TOK} as tokens from q),
w as (select source_file, block, id, is_pos, unnest(tokens) as word from b),
m as (select x.source_file, x.block, x.id as p_id, y.id as q_id, count(*) as common from w x join w y on x.source_file = y.source_file and x.block = y.block and x.word = y.word and x.is_pos and not y.is_pos group by 1, 2, 3, 4),
cand as (select m.source_file, m.block, case when (p.req_order, p.id) < (o.req_order, o.id) then p.id else o.id end as a_id, case when (p.req_order, p.id) < (o.req_order, o.id) then o.id else p.id end as b_id, least((p.req_order, p.id), (o.req_order, o.id)) as ak, greatest((p.req_order, p.id), (o.req_order, o.id)) as bk, p.id as p_id, o.id as o_id, common / least(len(p.tokens), len(o.tokens)) as score
from m join b p on p.id = m.p_id join b o on o.id = m.q_id where common / least(len(p.tokens), len(o.tokens)) >= 0.5),
f as (select source_file, block, min(req_order) as bo from b group by 1, 2),
top as (select * from (select *, row_number() over (partition by source_file order by bo, block, ib) as rank from (select *, row_number() over (partition by source_file, block order by score desc, ak, bk) as ib from cand) join f using (source_file, block) where ib <= 25) where rank <= 600)"""


@query(f", {_CAND} select source_file, block, a_id, b_id, round(score, 9) as score from cand")
def link_candidates(spark: SparkSession, d: str) -> DataFrame:
    return link.candidates(requirements(spark, d)).select("source_file", "block", "a_id", "b_id", F.round("score", 9).alias("score"))


@query(f", {_CAND} select source_file, block, a_id, b_id, ib::int as in_block, rank::int as rank from top")
def link_topk(spark: SparkSession, d: str) -> DataFrame:
    r = requirements(spark, d)
    return link.top_candidates(link.candidates(r), r).select("source_file", "block", "a_id", "b_id", "in_block", "rank")


@query(
    f""", {_CAND}, c as (select id, bullet_point as t, case when length(description_en) > 700 then description_en[1:700] || '…' else description_en end as d from requirements1)
select a_id, b_id, md5(concat_ws(chr(10), 'Requirement A:', 'Title: ' || a.t, a.d, '', 'Requirement B:', 'Title: ' || b.t, b.d)) as digest from top join c a on a.id = a_id join c b on b.id = b_id"""
)
def pair_messages(spark: SparkSession, d: str) -> DataFrame:
    r = requirements(spark, d)
    side = lambda s: r.select(F.col("id").alias(f"{s}_id"), F.col("bullet_point").alias(f"{s}_title"), F.col("description_en").alias(f"{s}_text"))
    both = link.top_candidates(link.candidates(r), r).join(side("a"), "a_id").join(side("b"), "b_id")
    return both.select("a_id", "b_id", F.md5(link.pair_message(*[F.col(c) for c in ("a_title", "a_text", "b_title", "b_text")])).alias("digest"))


def _seeded_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """The verdicts and, since few of them meet a candidate, a ``same`` for candidates whose ids end alike."""
    r = requirements(spark, d)
    own = link.candidates(r).filter(F.substring("a_id", -1, 1) == F.substring("b_id", -1, 1)).select("a_id", "b_id", F.lit("same").alias("relation"))
    return table(spark, d, "verdicts").select("a_id", "b_id", "relation").unionByName(own)


@query(
    f""", {_CAND}, v as (select least(a_id, b_id) as x, greatest(a_id, b_id) as y from verdicts where lower({trim_sql('relation')}) = 'same' union select least(a_id, b_id), greatest(a_id, b_id) from cand where right(a_id, 1) = right(b_id, 1))
select source_file, o_id as id, arg_min(p_id, rank) as position_id from top join v on v.x = least(a_id, b_id) and v.y = greatest(a_id, b_id) group by 1, 2"""
)
def link_closed_form(spark: SparkSession, d: str) -> DataFrame:
    r = requirements(spark, d)
    return link.linked(link.top_candidates(link.candidates(r), r), _seeded_verdicts(spark, d), r)


_recursive(
    "link_merge",
    f""", {_CAND}, v as (select least(a_id, b_id) as x, greatest(a_id, b_id) as y from verdicts where lower({trim_sql('relation')}) = 'same' union select least(a_id, b_id), greatest(a_id, b_id) from cand where right(a_id, 1) = right(b_id, 1)),
sd as (select top.source_file, o_id as id, p_id, p.item_number as code, first_value(p.item_number) over (partition by top.source_file, o_id order by rank) as first_code from top join v on v.x = least(a_id, b_id) and v.y = greatest(a_id, b_id) join requirements1 p on p.id = p_id),
e as (select source_file, id as a, p_id as b from sd where code = first_code), e2 as (select * from e union select source_file, b, a from e), r(source_file, id, other) as (select distinct source_file, a, a from e2 union select r.source_file, r.id, e2.b from r join e2 on e2.source_file = r.source_file and e2.a = r.other),
g as (select source_file, r.id, min(other) filter (where other in (select b from e)) as root from r group by 1, 2),
mb as (select q.*, coalesce(g.root, q.id) as root, {position_sql('item_number')} as pos from requirements1 q left join g on g.source_file = q.source_file and g.id = q.id),
ids as (select source_file, root, string_agg(c, ' ' order by o) as sources from (select source_file, root, c, min((req_order, id, i)) as o from (select source_file, root, req_order, id, unnest(source_chunk_ids) as c, unnest(range(len(source_chunk_ids))) as i from mb) group by 1, 2, 3) group by 1, 2),
tx as (select source_file, root, string_agg({trim_sql('t')}, chr(10) || chr(10) order by o) as text from (select source_file, root, {fold_sql('description_en')} as f, arg_min(description_en, (req_order, id)) as t, min((req_order, id)) as o from mb where description_en is not null and {fold_sql('description_en')} <> '' group by 1, 2, 3) group by 1, 2),
a as (select source_file, root, count(*) as n, min(id) as id, arg_min({{'b': bullet_point, 'i': item_number}}, {{'p': not pos, 'l': case when pos then 0 else -length(description_en) end, 'o': req_order, 'i': id}}) as rep, {_STRONGEST} as p, min(coalesce({_SURE.format(x='confidence')}, 3)) as c, arg_min(equivalence_allowed, (req_order, id)) filter (where equivalence_allowed is not null) as equivalence_allowed, min(merge_record.rule) as rule, min(priority) as own_p, min(confidence) as own_c, min(description_en) as own_t, first(array_to_string(source_chunk_ids, ' ')) as own_s from mb group by 1, 2)
select a.source_file, id, n as n_members, case when n > 1 then coalesce(sources, '') else own_s end as sources, case when n > 1 then 'semantic-link' else rule end as rule, rep.b as bullet_point, md5(case when n > 1 then coalesce(text, '') else own_t end) as digest, case when n > 1 then p else own_p end as priority, case when n = 1 then own_c else case c when 3 then 'high' when 2 then 'medium' else 'low' end end as confidence, equivalence_allowed, rep.i as item_number
from a left join ids using (source_file, root) left join tx using (source_file, root)""",
)


@query()
def link_merge(spark: SparkSession, d: str) -> DataFrame:
    r = requirements(spark, d)
    out = link.merge_linked(r, link.united(link.top_candidates(link.candidates(r), r), _seeded_verdicts(spark, d), r))
    return out.select("source_file", "id", "n_members", F.array_join("source_chunk_ids", " ").alias("sources"), "merge_record.rule", "bullet_point", F.md5("description_en").alias("digest"), "priority", "confidence", "equivalence_allowed", "item_number")


# Grounding.
_NUM = r"list_transform(regexp_extract_all({x}, '\d[\d., ]*\d|\d'), lambda t: replace(t, ' ', ''))"
_GROUND = f"""s as (select id, string_agg(concat_ws(chr(10), content, c.section_heading, c.lv_position), chr(10) order by pos) as src from (select id, unnest(source_chunk_ids) as chunk_id, unnest(range(len(source_chunk_ids))) as pos from requirements1) join chunks1 c using (chunk_id) group by 1),
g as (select id, confidence, list_filter({_NUM.format(x="coalesce(description_en, '')")}, lambda t: length(regexp_replace(t, '[0-9]', '', 'g')) <= 1) as vals,
{_NUM.format(x="concat_ws(chr(10), description_de, section_heading, item_number, category_code, array_to_string(coalesce(standards, []), ' '), src)")} as have from requirements1 left join s using (id)),
h as (select id, confidence, vals, list_distinct(have || list_transform(have, lambda t: replace(t, '.', ',')) || list_transform(have, lambda t: replace(t, ',', '.')) || list_transform(have, lambda t: regexp_replace(t, '[.,]', '', 'g'))) as forms from g),
checked as (select id, len(vals)::int as n_values, len(list_filter(vals, lambda t: not list_has_any(forms, [t, replace(t, '.', ','), replace(t, ',', '.'), regexp_replace(t, '[.,]', '', 'g')])))::int as n_ungrounded, confidence as was from h)"""


@query(f", {_GROUND} select id, n_values, n_ungrounded, case when n_ungrounded > 0 then 'low' else was end as confidence from checked")
def grounding_check(spark: SparkSession, d: str) -> DataFrame:
    return grounding.grounded(requirements(spark, d), chunks(spark, d))


@query(f", {_GROUND} select count_if(n_values > 0)::bigint as leaves_checked, count_if(n_ungrounded > 0)::bigint as leaves_flagged, sum(n_values)::bigint as values_checked, sum(n_ungrounded)::bigint as values_ungrounded from checked")
def grounding_stats(spark: SparkSession, d: str) -> DataFrame:
    return grounding.grounding_stats(grounding.grounded(requirements(spark, d), chunks(spark, d)))


# Grouping and the tree.
_SLUG = r"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g')[1:48]"


@query(
    f""", k as (select source_file, {KEY_SQL} as key, req_order, id, bullet_point, row_number() over (partition by source_file, {KEY_SQL} order by req_order, id) as n from requirements1)
select source_file, key, count(*) as n_items, min(req_order) as key_order, string_agg(bullet_point, ' | ' order by n) filter (where n <= 3) as examples from k group by 1, 2"""
)
def catalogue_top3(spark: SparkSession, d: str) -> DataFrame:
    return tree.catalogue(requirements(spark, d))


_FALLBACK = f"""l as (select source_file, id, req_order, coalesce(section_heading, 'Category ' || nullif(category_code, ''), 'General') as label from requirements1),
s as (select *, coalesce(nullif({_SLUG.format(x='label')}, ''), 'general') as l2_key from l),
fallback as (select source_file, id, 'requirements' as l1_key, 'Requirements' as l1_label, l2_key, first_value(label) over (partition by source_file, l2_key order by req_order, id) as l2_label from s)"""


@query(f", {_FALLBACK} select * from fallback")
def fallback_groups(spark: SparkSession, d: str) -> DataFrame:
    return tree.fallback_groups(requirements(spark, d))


_TAXONOMY = f"""t0 as (select {KEY_SQL} as key, length({KEY_SQL}) % 5 as k from requirements1), taxonomy as (select distinct key, case k when 0 then 'Building Works' when 1 then 'Fittings & Furniture' when 2 then 'Services' else 'Site' end as l1, 'Part ' || key as l2 from t0 where k < 4)"""


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """A taxonomy by the length of the key that leaves a fifth of the lengths unassigned; every key is assigned twice, the first time counts."""
    keys = requirements(spark, d).select(link.group_key().alias("key")).distinct().withColumn("k", F.length("key") % 5).filter("k < 4")
    l1 = F.when(F.col("k") == 0, "Building Works").when(F.col("k") == 1, "Fittings & Furniture").when(F.col("k") == 2, "Services").otherwise("Site")
    first = keys.select("key", l1.alias("l1"), F.concat(F.lit("Part "), "key").alias("l2"), F.lit(0).alias("ord"))
    return first.unionByName(keys.select("key", F.lit("Later").alias("l1"), F.lit("Later").alias("l2"), F.lit(1).alias("ord")))


_TAXED = f"""{_TAXONOMY}, taxed as (select source_file, id, case when t.key is null then 'other' else {_SLUG.format(x='l1')} end as l1_key, coalesce(l1, 'Other Requirements') as l1_label, case when t.key is null then 'other__general' else {_SLUG.format(x='l1')} || '__' || {_SLUG.format(x=KEY_SQL)} end as l2_key, coalesce(l2, 'General') as l2_label from requirements1 left join taxonomy t on t.key = {KEY_SQL})"""


@query(f", {_TAXED} select * from taxed")
def taxonomy_lookup_other(spark: SparkSession, d: str) -> DataFrame:
    return tree.taxonomy_groups(requirements(spark, d), taxonomy(spark, d))


@query(
    f""", o as (select source_file, id, row_number() over (partition by source_file order by req_order, id) - 1 as idx from requirements1)
select source_file, id, case when idx % 10 < 8 then 'group_' || (idx % 4) else 'other' end as l1_key, case when idx % 10 < 8 then 'Group ' || (idx % 4) else 'Other Requirements' end as l1_label, case when idx % 10 < 8 then 'group_' || (idx % 4) || '__all' else 'other__general' end as l2_key, case when idx % 10 < 8 then 'All' else 'General' end as l2_label from o"""
)
def index_claims(spark: SparkSession, d: str) -> DataFrame:
    """A reply that puts each place with a last digit below 8 into one of four groups, claims all of them once more in a fifth, and places out of range."""
    n = requirements(spark, d).groupBy("source_file").agg(F.count("*").cast("int").alias("n"))
    places = n.select("source_file", F.explode(F.sequence(F.lit(0), F.col("n") + 3)).alias("i")).filter("i % 10 < 8")
    four = places.groupBy("source_file", (F.col("i") % 4).alias("l1_ord")).agg(F.array_sort(F.collect_list("i")).alias("indices")).withColumn("l1", F.concat(F.lit("Group "), F.col("l1_ord").cast("string")))
    again = places.groupBy("source_file").agg(F.array_sort(F.collect_list("i")).alias("indices")).withColumn("l1_ord", F.lit(9)).withColumn("l1", F.lit("Again"))
    reply = four.unionByName(again).withColumn("l2_ord", F.lit(0)).withColumn("l2", F.lit("All"))
    return tree.claimed_groups(requirements(spark, d), reply)


@query(f", {_TAXED} select source_file, l1_key, l2_key, count(*) as n_leaves from taxed group by rollup (source_file, l1_key, l2_key) having source_file is not null")
def leaf_counts(spark: SparkSession, d: str) -> DataFrame:
    return tree.level_counts(tree.taxonomy_groups(requirements(spark, d), taxonomy(spark, d)))


@query(f", {_TAXED} select source_file, count(distinct l1_key) as n_l1, count(distinct (l1_key, l2_key)) as n_l2, count(*) as n_requirements from taxed group by 1")
def group_counts(spark: SparkSession, d: str) -> DataFrame:
    return tree.group_counts(tree.taxonomy_groups(requirements(spark, d), taxonomy(spark, d)))


@query("select source_file, document_region, count(*) as n_chunks from chunks1 group by 1, 2")
def region_counts(spark: SparkSession, d: str) -> DataFrame:
    return segment.region_counts(chunks(spark, d))


@query(
    """, c as (select source_file, nullif(lower(source_language)[1:2], '') as l, count(*) as n, min(req_order) as f from requirements1 group by 1, 2)
select source_file, coalesce(arg_max(l, (n, -f)) filter (where l is not null), 'en') as language from c group by 1"""
)
def dominant_language(spark: SparkSession, d: str) -> DataFrame:
    return tree.dominant_language(requirements(spark, d))


def _tree_sql(groups: str, table_: str, description: bool) -> str:
    """The node table of groups (source_file, id, l1_key, l1_label, l2_key, l2_label), with the texts of the leaves where asked for."""
    texts = ", {en} as description_en, {other} as description_other" if description else ""
    none, own = texts.format(en="null", other="null"), texts.format(en="description_en", other="case when description_de <> '' and language <> 'en' then description_de end")
    return f""", {groups}, lg as (select source_file, coalesce(arg_max(l, (n, -f)) filter (where l is not null), 'en') as language from (select source_file, nullif(lower(source_language)[1:2], '') as l, count(*) as n, min(req_order) as f from requirements1 group by 1, 2) group by 1), q as (select r.*, language, l1_key, l1_label, l2_key, l2_label, (req_order, id) as o from requirements1 r join {table_} using (source_file, id) join lg using (source_file)),
a as (select *, dense_rank() over (partition by source_file order by o1) - 1 as i1 from (select *, min(o) over (partition by source_file, l1_key) as o1, min(o) over (partition by source_file, l1_key, l2_key) as o2 from q)),
b as (select *, dense_rank() over (partition by source_file, l1_key order by o2) - 1 as i2, row_number() over (partition by source_file, l1_key, l2_key order by o) - 1 as i3 from a)
select source_file, 'r' as path, null as parent_path, 0 as depth, 0 as ord, source_file as bullet_point, 'must' as priority, null as confidence, sum(len(source_chunk_ids))::bigint as n_chunks{none} from b group by all
union all select source_file, 'r.' || i1, 'r', 1, i1::int, arg_min(l1_label, o), 'must', null, sum(len(source_chunk_ids))::bigint{none} from b group by source_file, i1
union all select source_file, 'r.' || i1 || '.' || i2, 'r.' || i1, 2, i2::int, arg_min(l2_label, o), 'must', null, sum(len(source_chunk_ids))::bigint{none} from b group by source_file, i1, i2
union all select source_file, 'r.' || i1 || '.' || i2 || '.' || i3, 'r.' || i1 || '.' || i2, 3, i3::int, bullet_point, priority, confidence, len(source_chunk_ids)::bigint{own} from b"""


@query(_tree_sql(_TAXED, "taxed", False))
def tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    r = requirements(spark, d)
    return tree.tree_nodes(r, tree.taxonomy_groups(r, taxonomy(spark, d))).select("source_file", "path", "parent_path", "depth", "ord", "bullet_point", "priority", "confidence", F.size("chunk_ids").cast("long").alias("n_chunks"))


@query(_tree_sql(_FALLBACK, "fallback", True))
def tree_json_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The nested JSON of each tender, taken apart again."""
    made = tree_json(spark, d).select(F.col("source_file").alias("tree_id"), "tree_json", F.current_timestamp().alias("produced_at"), F.current_timestamp().alias("loaded_at"))
    nodes, links = nested.tree_nodes(made), nested.tree_links(made).filter("link = 'chunk'").groupBy("tree_id", F.col("parent_path").alias("path")).agg(F.count("*").alias("n_chunks"))
    texts = F.from_json("description", "map<string,string>")
    other = F.get(F.map_values(F.map_filter(texts, lambda k, _: k != "en")), F.lit(0))
    out = nodes.join(links, ["tree_id", "path"], "left")
    return out.select(F.col("tree_id").alias("source_file"), "path", "parent_path", "depth", "ord", "bullet_point", "priority", "confidence", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), texts["en"].alias("description_en"), other.alias("description_other"))


@query("select null::varchar as source_file, null::varchar as path, null::varchar as field where false")
def tree_contract(spark: SparkSession, d: str) -> DataFrame:
    """What of the nested JSON breaks the output contract, where the texts of requirements are given: nothing."""
    r = requirements(spark, d).withColumns({c: F.coalesce(c, F.lit(x)) for c, x in (("bullet_point", "-"), ("description_en", ""), ("priority", "optional"))})
    return tree.contract_errors(tree.tree_json(tree.tree_nodes(r, tree.fallback_groups(r))))


@query(f", {_FALLBACK} select source_file, count(*) as n_leaves from fallback group by 1")
def tree_leaf_counts(spark: SparkSession, d: str) -> DataFrame:
    r = requirements(spark, d)
    return tree.leaf_count(tree.tree_nodes(r, tree.fallback_groups(r)))


@query()
def tree_json(spark: SparkSession, d: str) -> DataFrame:
    r = requirements(spark, d)
    return tree.tree_json(tree.tree_nodes(r, tree.fallback_groups(r)))


# Evaluation.
@query(
    rf""", f as (select item_id, list_filter(regexp_split_to_array(text, '[^\p{{L}}\p{{N}}]+'), lambda w: length(w) > 8) as context, regexp_extract_all(text, '\d+') as vals from benchmark),
l as (select id, {fold_sql("concat_ws(' ', bullet_point, description_en, description_de)")} as text from requirements1),
n as (select item_id, id, len(list_filter(vals, lambda v: not contains(text, lower(v)))) = 0 as whole from f join l on len(list_filter(context, lambda c: contains(text, lower(c)))) > 0)
select f.item_id as fact_id, coalesce(count(n.id), 0) as n_named, count_if(coalesce(whole, false))::bigint as n_complete, count_if(coalesce(whole, false)) > 0 as found from f left join n using (item_id) group by 1"""
)
def golden_eval(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items as facts (200 at any scale): long words are their context, numbers their values."""
    b = table(spark, d, "benchmark")
    facts = b.select(F.col("item_id").alias("fact_id"), F.filter(F.split("text", r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 8).alias("context"), F.regexp_extract_all("text", F.lit(r"\d+"), 0).alias("values"), F.lit(None).cast("boolean").alias("equivalence"))
    leaves = requirements(spark, d).select("id", F.concat_ws(" ", "bullet_point", "description_en", "description_de").alias("text"), "equivalence_allowed")
    return evaluate.score(leaves, facts)


# Names.
@query(r"select distinct source_file, regexp_replace(lower(regexp_replace(source_file, '\.pdf$', '')), '[^a-z0-9]+', '-', 'g') as slug, regexp_replace(lower(regexp_replace(source_file, '\.pdf$', '')), '\s+', '-', 'g') as folder from chunks where source_file is not null")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").filter("source_file is not null").select("source_file", T.file_slug("source_file").alias("slug"), T.folder_name("source_file").alias("folder")).distinct()


_NESTED = r"""recursive t as (select tree_id, arg_max(tree_json, (produced_at, loaded_at))::json as j from deliverable_trees where tree_id is not null and json_valid(tree_json) group by 1),
n(tree_id, path, ord, j) as (select tree_id, 'r', 0, j from t where json_type(j) <> 'NULL' union all select tree_id, path || '.' || (i - 1), (i - 1)::int, kids[i] from (select tree_id, path, kids, unnest(range(1, len(kids) + 1)) as i from (select tree_id, path, case json_type(j, '$.deliverableArray') when 'ARRAY' then json_extract(j, '$.deliverableArray[*]') when 'NULL' then [] else [json_extract(j, '$.deliverableArray')] end as kids from n where json_type(j, '$.deliverableArray') is not null)) where json_type(kids[i]) <> 'NULL')"""
_FIELD = "case when json_type(j, '$.{x}') in ('OBJECT', 'ARRAY') then json_extract(j, '$.{x}')::varchar else json_extract_string(j, '$.{x}') end"
SQL["p4_nodes"] = f"""with {_NESTED} select tree_id, path, case when path <> 'r' then regexp_replace(path, '[.][0-9]+$', '') end as parent_path, len(string_split(path, '.'))::int - 1 as depth, ord,
{_FIELD.format(x='bulletPoint')} as bullet_point, {_FIELD.format(x='description')} as description, {_FIELD.format(x='priority')} as priority, {_FIELD.format(x='confidence')} as confidence, {_FIELD.format(x='status')} as status, json_type(j) = 'OBJECT' as is_object from n"""
SQL["p4_subtrees"] = f"""with {_NESTED}, k as (select tree_id, path, not exists (select 1 from n c where c.tree_id = n.tree_id and c.path like n.path || '.%') as leaf from n)
select n.tree_id, n.path, count(*) as n_nodes, count_if(k.leaf)::bigint as n_leaves from n join k on k.tree_id = n.tree_id and (k.path = n.path or k.path like n.path || '.%') group by 1, 2"""
SQL["p4_found"] = r"""with recursive t as (select tree_id, arg_max(tree_json, (produced_at, loaded_at))::json as j from deliverable_trees where tree_id is not null and json_valid(tree_json) group by 1),
n(tree_id, path, j) as (select tree_id, 'r', j from t union all select tree_id, path || '.' || (i - 1), kids[i] from (select tree_id, path, kids, unnest(range(1, len(kids) + 1)) as i from (select tree_id, path, case json_type(j, '$.deliverableArray') when 'ARRAY' then json_extract(j, '$.deliverableArray[*]') when 'NULL' then [] else [json_extract(j, '$.deliverableArray')] end as kids from n where json_type(j, '$.deliverableArray') is not null)) where json_type(kids[i]) <> 'NULL'),
d as (select tree_id, path, 'deliverable' as link, case json_type(j, '$.deliverableArray') when 'ARRAY' then json_extract(j, '$.deliverableArray[*]') when 'NULL' then [] else [json_extract(j, '$.deliverableArray')] end as kids from n where json_type(j, '$.deliverableArray') is not null
union all select tree_id, path, 'chunk', case json_type(j, '$.procurementDocumentChunkIdArray') when 'ARRAY' then json_extract(j, '$.procurementDocumentChunkIdArray[*]') when 'NULL' then [] else [json_extract(j, '$.procurementDocumentChunkIdArray')] end from n where json_type(j, '$.procurementDocumentChunkIdArray') is not null)
select tree_id, path as parent_path, link, (i - 1)::int as ord, case link when 'chunk' then kids[i]->>'$' else path || '.' || (i - 1) end as child from (select *, unnest(range(1, len(kids) + 1)) as i from d) where json_type(kids[i]) <> 'NULL'"""
