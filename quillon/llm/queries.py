"""The queries opN_<name> of the corpus operators, and DuckDB SQL for those that SQL can express.

Each query applies its operator with production parameters to its whole table and derives the columns of its contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.alignment import align
from quillon.llm.audit import audit_filters
from quillon.llm.bpe import round_trip
from quillon.llm.common import table
from quillon.llm.langid import fit, held_out, identify
from quillon.llm.licenses import scan_licenses
from quillon.llm.mixing import mix
from quillon.llm.packing import pack_sequences
from quillon.llm.quality import BASE as QUALITY_BASE
from quillon.llm.quality import quality_rules
from quillon.llm.simhash import near_duplicates
from quillon.llm.substring import drop_duplicate_spans
from quillon.llm.tokenfile import read_tokens, write_tokens
from quillon.llm.topk import top_k
from quillon.llm.warc import read_archives, write_archives


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = write_tokens(table(spark, sf_dir, "documents"))
    return read_tokens(spark, folder, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_duplicate_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.expr("cast(octet_length(ids) div 4 as bigint)")
    return out.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *QUALITY_BASE, "base_failed", "kept")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(spark, folder, files)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_sequences(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align(table(spark, sf_dir, "documents"), groups=digest).withColumnRenamed("groups", "groups_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_token_files, op3_top_k, op4_substring_dedup, op5_bpe, op6_warc, op7_mix_sources, op8_quality_rules, op9_license_scan, op10_simhash,
        op11_packing, op12_filter_audit, op13_alignment,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op3_top_k": """
        with v as (select row_number() over () as k, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
            where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.k, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score from v q join v c on q.k <> c.k where q.vec_id % 50 = 0),
        r as (select *, row_number() over (partition by k order by score desc, vec_id) as rank from s)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5""",
    "op6_warc": """
        with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as k, sha1(coalesce(html, '')) as hex from pages),
        f as (select *, min(page_id) over (partition by k) as first_id from p),
        d as (select *, list_transform(range(8), lambda g: ('0x' || substr(hex, g * 5 + 1, 5))::bigint) as parts from f)
        select page_id, cast(payload_bytes as bigint) as payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') as payload_digest,
            case when first_id < coalesce(page_id, 9223372036854775807) then 'revisit' else 'response' end as record_type,
            case when first_id < coalesce(page_id, 9223372036854775807) then first_id end as refers_to
        from d""",
    "op4_substring_dedup": rf"""
        with d as (select row_number() over () as k, doc_id, {_WORDS} as words from documents),
        w as (select k, doc_id, unnest(range(1, len(words) - 11)) as p, words from d),
        h as (select k, doc_id, p, array_to_string(words[p : p + 12], ' ') as seq from w),
        m as (select k, p, doc_id, min(doc_id) over (partition by seq) as low from h),
        g as (select distinct k, unnest(range(p, p + 13)) as i from m where low < doc_id or (doc_id is null and low is not null)),
        r as (select k, count(*) as n_removed, list(i) as gone from g group by k)
        select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
            sha256(array_to_string(case when gone is null then words else list_transform(list_filter(range(1, len(words) + 1), lambda x: not list_contains(gone, x)), lambda x: words[x]) end, ' ')) as kept_sha256
        from d left join r on d.k = r.k""",
    "op7_mix_sources": rf"""
        with d as (select doc_id, source, len({_WORDS}) as size, md5('mix-1:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as h from documents),
        s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
        r as (select *, row_number() over (order by source is null, source) - 1 as rk from s),
        w as (select source, source_size, case rk % 3 when 0 then 5.0::double when 1 then 2.0 else 1.0 end as w, source_size * 2.0::double as cap from r),
        b as (select *, sum(source_size) over () * 1.5::double - coalesce(sum(cap) over prior, 0) as lft, sum(w) over () - coalesce(sum(w) over prior, 0) as wleft
            from w window prior as (order by cap / w, source is null, source rows between unbounded preceding and 1 preceding)),
        l as (select arg_min(lft / wleft, cap / w) as level from b where lft / wleft * w < cap),
        t as (select source, source_size, round(least(cap, coalesce((select level from l) * w, cap)), 6) as target from w),
        p as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from t),
        q as (select *, cast(round(target - whole * source_size) as bigint) as part from p),
        o as (select d.doc_id, d.size, q.source_size, q.target, q.whole, q.part,
            coalesce(sum(d.size) over (partition by d.source order by h, d.size rows between unbounded preceding and 1 preceding), 0) as before_
            from d join q on d.source is not distinct from q.source)
        select doc_id, cast(size as bigint) as size, source_size, target,
            cast(whole * size + greatest(0, least(size, part - before_)) as bigint) as taken from o""",
    "op8_quality_rules": rf"""
        with d as (select row_number() over () as k, doc_id, coalesce(text, '') as text, {_WORDS} as words from documents),
        p as (select k, unnest(range(1, len(words) - 1)) as i, words from d),
        g as (select k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as win from p),
        c as (select k, i from (select k, i, count(*) over (partition by k, win) as n from g) where n > 1),
        v as (select k, count(distinct j) as n_repeat_words from (select k, unnest([i, i + 1, i + 2]) as j from c) group by k),
        f as (select d.k, doc_id, text, words, string_split(text, chr(10)) as lines, len(words) as n_words,
            coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols, coalesce(n_repeat_words, 0) as n_repeat_words
            from d left join v on d.k = v.k),
        n as (select *, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as full_lines from f),
        m as (select *, len(full_lines) - len(list_distinct(full_lines)) as n_dup_lines, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from n)
        select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
            cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
            not (base_failed or word_chars > 40 * n_words or 10 * n_symbols > 3 * word_chars
                or (n_dup_lines >= 5 and 10 * n_dup_lines > 9 * len(lines)) or 10 * n_repeat_words > 4 * n_words
                or 2 * length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) < word_chars
                or 2 * len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) < n_words
                or (n_words >= 50 and 2 * len(list_filter(lines, lambda x: ends_with(rtrim(x, ' '), '...') or ends_with(rtrim(x, ' '), '…'))) > len(lines))
                or (n_words >= 50 and 10 * len(list_filter(lines, lambda x: substring(ltrim(x, ' '), 1, 1) in ('-', '*', '•'))) > 9 * len(lines))) as kept
        from m""",
    "op12_filter_audit": rf"""
        with l as (select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic from labels where doc_id is not null group by doc_id),
        d as (select documents.doc_id, coalesce(source, '') as part, coalesce(text, '') as text, {_WORDS} as words, coalesce(good, false) as good, coalesce(toxic, false) as toxic
            from documents left join l on documents.doc_id = l.doc_id),
        b as (select part, good, toxic, (len(words) < 200)::bigint + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::bigint
            + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text))::bigint + 8 * regexp_matches(text, '[#$%&*|]')::bigint
            + 16 * coalesce(min(doc_id) over (partition by text) < doc_id, false)::bigint as bits from d),
        m as (select part, bits, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as t from b group by part, bits),
        o as (select [a, b, c, d, e] as o from range(5) x(a), range(5) y(b), range(5) z(c), range(5) u(d), range(5) v(e) where len(list_distinct([a, b, c, d, e])) = 5),
        s as (select o, step, 1 << o[step] as f, coalesce(list_sum(list_transform(o[1 : step - 1], lambda x: 1 << x)), 0)::bigint as prior from o, range(1, 6) r(step)),
        r as (select part, o, step, f,
            coalesce(sum(n) filter (bits & (prior | f) = 0), 0) as kept, coalesce(sum(n) filter (bits & prior = 0 and bits & f > 0), 0) as removed,
            coalesce(sum(n) filter (bits & prior > 0 and bits & f > 0), 0) as redundant, coalesce(sum(n) filter (bits = f), 0) as unique_fails,
            coalesce(sum(g) filter (bits & prior = 0 and bits & f > 0), 0) as good_lost, coalesce(sum(t) filter (bits & prior = 0 and bits & f > 0), 0) as toxic_lost
            from s, m group by part, o, step, f)
        select part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x::int + 1, 1)), '') as filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
            redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
            sum(removed) over (partition by part, f)::bigint as shapley from r""",
}
