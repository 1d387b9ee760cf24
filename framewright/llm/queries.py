"""One query per operator over its whole table, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import ans, decontam, lines, merkle, ngrams, packing, quality, repair, secrets, sharding, simhash, toxicity, urls
from framewright.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary=public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_length"
    )


@query()
def op2_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rans")
    ans.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary=public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return ans.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


EIGHT = dict.fromkeys(range(8), 1.0)
NINE = dict.fromkeys(range(9), 1.0)
# CRC-32 byte by byte: each step shifts in one byte through the table of the 256 remainders.
CRC_SQL = """
with bits as (
    select list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as remainder, b
    from range(256) t(b)
), remainders as (select list(remainder order by b) as r from bits),
texts as (select doc_id, coalesce(text, '') as text, hex(encode(coalesce(text, ''))) as h from documents),
crcs as (
    select doc_id, strlen(text) + 1 as size,
        xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
            list_transform(range(strlen(text)), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
            lambda c, x: xor(c >> 8, r[1 + (xor(c, x) & 255)]))) as text_crc32
    from texts, remainders
)"""


@query(
    CRC_SQL
    + """,
draws as (
    select d.*, s as shard, md5(coalesce(doc_id::varchar, 'null') || ':' || s) as digest
    from crcs d, range(9) t(s)
), costs as (select *, -ln((('0x' || substr(digest, 1, 13))::bigint + 0.5) / 4503599627370496.0) as cost from draws),
chosen as (
    select doc_id, size, text_crc32, arg_min(shard, (cost, shard)) filter (shard < 8) as shard,
        arg_min(digest, (cost, shard)) filter (shard < 8) as digest, arg_min(shard, (cost, shard)) as grown_shard
    from costs group by doc_id, size, text_crc32
)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'key' as law, shard::int as shard,
    row_number() over (partition by shard order by digest, text_crc32, size) - 1 as slot, grown_shard::int as grown_shard
from chosen"""
)
def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), EIGHT, grown=NINE)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query()
def op3_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query()
def op7_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    labels = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), labels, RULES)


@query(
    r"""
with t as (select doc_id, coalesce('h' || source, '') as name, coalesce(text, '') as c from documents),
w as (select *, list_filter(string_split_regex(c, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws, substr(md5(c), 1, 15) as h from t),
windows as (select doc_id, h, unnest(range(1, len(ws) - 3)) as p, ws from w),
hashed as (select doc_id, h, p, list_aggregate(ws[p : p + 4], 'string_agg', ' ') as g from windows),
twice as (select doc_id, h, p from hashed qualify count(*) over (partition by doc_id, h, g) > 1),
repeats as (
    select doc_id, h, sum(least(5, p - coalesce(before, -5))) as n
    from (select *, lag(p) over (partition by doc_id, h order by p) as before from twice) group by all
),
texts as (select distinct name, h, c from w),
lines as (
    select name, h, substr(md5(l), 1, 15) as line, sum(len(string_split(l, ' '))) as words
    from (select name, h, trim(unnest(string_split(lower(regexp_replace(c, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10))), ' ') as l from texts)
    where l <> '' group by all
),
sizes as (select name, count(*) as texts from texts group by name),
often as (
    select name, line, min(h) as first from lines join sizes using (name) group by name, line
    having count(*) > 20 or count(*) > 5 and count(*) > 0.2 * max(texts)
),
gone as (select name, h, sum(words) as removed from lines join often using (name, line) where h <> first group by all),
base as (
    select doc_id, name, h, len(ws)::bigint as n_words,
        length(list_aggregate(ws, 'string_agg', ''))::bigint as word_chars,
        length(regexp_replace(c, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
    from (select *, list_filter(string_split(c, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from w)
    left join repeats using (doc_id, h)
)
select doc_id, n_words, coalesce(word_chars, 0) as word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    coalesce(removed, 0)::bigint as removed_words,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and coalesce(removed, 0) <= 0.5 * n_words as kept
from base left join gone using (name, h)"""
)
def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_rules(table(spark, sf_dir, "documents")).drop("source", "text")


@query()
def op6_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op10_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(docs)).drop("text")
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "field")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("secrets")).alias("spans")
    )


@query()
def op9_nearest_toxic_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    remainder = lambda: F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    index = toxicity.train(docs, labels.where(remainder() != 1))
    scored = toxicity.score(docs, index)
    return scored.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score", "predicted", "evidence")


@query()
def op4_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10))
    model = ngrams.train(docs.where(F.coalesce(remainder != 0, F.lit(True))))
    scored = ngrams.score(docs, model)
    held = F.coalesce(remainder == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@query()
def op11_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = lambda: F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    scored = quality.rate(docs, labels.where(remainder() != 2))
    return scored.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "score", "predicted")


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FIELD_SQL = lambda x: f"coalesce(strlen(({x})::varchar)::varchar || ':' || ({x})::varchar, '-')"


@query(
    f"""
with recursive bits as (
    select list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as remainder, b
    from range(256) t(b)
), remainders as (select list(remainder order by b) as r from bits),
rows as (
    select d.*, coalesce('=' || lang, '') as name, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
        list_transform(range(strlen(doc_id::varchar)), lambda i: ascii(substr(doc_id::varchar, i + 1, 1))::bigint)),
        lambda c, x: xor(c >> 8, r[1 + (xor(c, x) & 255)]))) as crc
    from documents d, remainders
), leaves as (
    select doc_id, name, sha256({" || ".join(map(FIELD_SQL, FIELDS))}) as leaf,
        sha256({" || ".join(FIELD_SQL("n_chars + case when crc % 7 = 0 then 1 else 0 end" if f == "n_chars" else f) for f in FIELDS)}) as changed,
        crc is not null and crc % 7 = 0 as tampered
    from rows
), placed as (
    select doc_id, name, leaf, case when tampered then changed else leaf end as claimed,
        row_number() over (partition by name order by doc_id nulls first, leaf) - 1 as p, count(*) over (partition by name) as n
    from leaves
), tree as (
    select name, 0 as level, p, leaf as node, n from placed
    union all
    select name, any_value(level) + 1, p // 2, sha256(string_agg(node, '' order by p)), (any_value(n) + 1) // 2 from tree where n > 1 group by name, p // 2
), tops as (select name, node, row_number() over (order by name) - 1 as p, count(*) over () as n from tree where n = 1),
upper as (
    select 0 as level, p, node, n from tops
    union all
    select any_value(level) + 1, p // 2, sha256(string_agg(node, '' order by p)), (any_value(n) + 1) // 2 from upper where n > 1 group by p // 2
),
steps as (
    select d.name, d.p, s.level, (d.p >> s.level) & 1 as odd, coalesce(t.node, '') as other
    from placed d join (select distinct name, level from tree where n > 1) s using (name)
    left join tree t on t.name = d.name and t.level = s.level and t.p = xor(d.p >> s.level, 1)
),
own as (
    select name, p, list(struct_pack(l := case odd when 1 then other else '' end, r := case odd when 1 then '' else other end) order by level) as path
    from steps group by all
),
high as (
    select d.name, list(struct_pack(l := case (d.p >> s.level) & 1 when 1 then coalesce(t.node, '') else '' end,
        r := case (d.p >> s.level) & 1 when 1 then '' else coalesce(t.node, '') end) order by s.level) as path
    from tops d, (select distinct level from upper where n > 1) s
    left join upper t on t.level = s.level and t.p = xor(d.p >> s.level, 1) group by d.name
),
proofs as (
    select d.doc_id, d.leaf, d.claimed, x.node as subroot, (select node from upper where n = 1) as root,
        list_concat(coalesce(own.path, []), coalesce(high.path, [])) as path
    from placed d join tops x using (name) left join own on own.name = d.name and own.p = d.p left join high on high.name = d.name
),
checked as (
    select *, sha256(coalesce(list_aggregate(list_transform(path, lambda s: s.l || s.r), 'string_agg', ''), '')) as proof_sha256,
        list_reduce(list_prepend(struct_pack(l := claimed, r := ''), path), lambda a, s: struct_pack(l := sha256(s.l || a.l || s.r), r := '')).l as folded_root
    from proofs
)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from checked"""
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, F.lit(False))
    changed = [F.col(f) + F.when(tampered, 1).otherwise(0) if f == "n_chars" else F.col(f) for f in FIELDS]
    rows = merkle.manifest(docs, fields=FIELDS, also={"claimed": merkle.leaf(*changed)})
    root = merkle.folded(F.col("claimed"), F.col("path"))
    proof = F.sha2(merkle.siblings(F.col("path")), 256)
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), root.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


REPAIR_SQL = r"""
with recursive bits as (
    select list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as remainder, b
    from range(256) t(b)
), remainders as (select list(remainder order by b) as r from bits),
whole as (
    select coalesce('=' || conv_id, '') as name, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
    from conversations
), hit as (
    select *, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen(k)), lambda i: ascii(substr(k, i + 1, 1))::bigint)),
        lambda c, x: xor(c >> 8, r[1 + (xor(c, x) & 255)]))) % 20 as kind
    from whole, remainders
), damaged as (
    select name, turn, case kind when 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from hit, range(2) c(copy) where kind <> 0 and (copy = 0 or kind = 3)
), placed as (
    select *, row_number() over (partition by name order by turn nulls first, sha256(strlen(role) || ':' || role || ':' || text)) as i,
        count(*) over (partition by name) as n, left(role, 1) as c, regexp_replace(text, '[\x20\x09-\x0D]+$', '') as bare
    from damaged
), faults as (
    select *, case when bare = '' then 'blank' when row_number() over (partition by name, role, text order by i) > 1 then 'duplicate'
        when right(bare, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
        (lag(c) over (partition by name order by i)) || c as pair
    from placed
), costed as (
    select *, fault in ('blank', 'duplicate') as must, case when fault = 'truncated' then 1 else 0 end as late,
        [case c when 's' then 2 when 'u' then 3 end, case c when 'u' then 3 end, case c when 'a' then 4 end, case c when 'u' then 3 end] as kept
    from faults
), back as (
    select name, any_value(n) + 1 as i, [0::bigint, 4, 2, 0] as v from costed group by name
    union all
    select name, i, [least(w[1], 2 + w[3], 4 + w[4]), least(w[2], 2 + w[3], 4 + w[4]), least(w[3], 2 + w[4]), least(w[4], 2 + w[3])]
    from (
        select r.name, r.i, list_transform([1, 2, 3, 4], lambda q: least(3 + b.v[q],
            case when r.must then 1000000 else 2 + r.late + b.v[[3, 3, 4, 3][q]] end,
            case when r.must or r.kept[q] is null then 1000000 else r.late + b.v[r.kept[q]] end)) as w
        from back b join costed r on r.name = b.name and r.i = b.i - 1
    )
), walk as (
    select name, 1::bigint as i, 1 as q, '' as audit, []::varchar[] as lines from back where i = 1
    union all
    select name, case e when 'I' then i else i + 1 end, case e when 'D' then q when 'K' then kept[q] else [3, 3, 4, 3][q] end, audit || e,
        case e when 'D' then lines else list_append(lines, case e when 'K' then role else ['user', 'user', 'assistant', 'user'][q] end || ':' || case e when 'I' then '' else text end) end
    from (
        select w.*, r.kept, r.role, r.text, case when b.v[w.q] = 3 + a.v[w.q] then 'D' when b.v[w.q] = 2 + b.v[[3, 3, 4, 3][w.q]] then 'I'
            when not r.must and b.v[w.q] = r.late + a.v[r.kept[w.q]] then 'K' else 'R' end as e
        from walk w join back b on b.name = w.name and b.i = w.i left join back a on a.name = w.name and a.i = w.i + 1
        left join costed r on r.name = w.name and r.i = w.i
        where r.i is not null or b.v[w.q] > 0
    )
), counts as (
    select name, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, any_value(n) as n,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
    from faults group by name
), repaired as (
    select c.*, b.v[1] as cost, w.audit, sha256(coalesce(list_aggregate(w.lines, 'string_agg', chr(10)), '')) as repaired_sha256
    from counts c join back b on b.name = c.name and b.i = 1
    join (select name, arg_max(audit, length(audit)) as audit, arg_max(lines, length(audit)) as lines from walk group by name) w on w.name = c.name
)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
    coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id, coalesce('=' || conv_id, '') as name from conversations) left join repaired using (name)"""


@query(REPAIR_SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    damage = F.pmod(F.crc32(F.concat_ws(":", written("conv_id"), written("turn")).cast("binary")), F.lit(20))
    text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace(written("text"), "[.!?]", "")).otherwise(written("text"))
    role = F.when(damage == 4, "user").otherwise(written("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(damage == 3, 2).otherwise(1)))
    damaged = rows.where(damage != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy"))
    found = repair.repair(damaged)
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    every = rows.select(F.col("conv_id").alias("own")).distinct()
    joined = every.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(F.col("own").alias("conv_id"), *[F.coalesce(c, none.get(c, F.lit(0))).alias(c) for c in found.columns[1:]])
