"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from evenkeel.llm import (
    archive,
    contamination,
    duplicates,
    extraction,
    fingerprints,
    language,
    licenses,
    mixing,
    outliers,
    prefixes,
    quantize,
    scoring,
    secrets,
)
from evenkeel.llm.common import ship_package


Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    def work(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return work


def queries() -> dict[str, Query]:
    return {name: shipped(query) for name, query in PLAIN.items()}


PLAIN: dict[str, Query] = {
    "op1_decontamination": contamination.contamination_report,
    "op2_html_text": extraction.page_texts,
    "op3_language": language.predictions,
    "op4_near_duplicates": duplicates.duplicate_report,
    "op5_lm_scores": scoring.language_model_scores,
    "op6_licenses": licenses.license_report,
    "op7_mixing": mixing.mixture,
    "op8_secrets": secrets.secret_report,
    "op9_fingerprints": fingerprints.document_fingerprints,
    "op10_warc": archive.archived_pages,
    "op11_vector_codes": quantize.code_report,
    "op12_quality": outliers.quality_report,
    "op13_prefix_trie": prefixes.trie_report,
    "pipeline": corpus_pipeline.run,
}


WORDS = """
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')
"""


def sql_secrets() -> str:
    """Spans from the lengths of pieces and matches, and standings from owners per value."""

    def spans(rank: int, kind: secrets.Kind) -> str:
        pattern = kind.pattern.replace("'", "''")
        lengths = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
        start = f"{lengths.format('pieces[1:i]')} + {lengths.format('found[1:i - 1]')}"
        return f"""
        select doc_id, source, {rank} as rank, '{kind.name}' as kind, {start} as first, {start} + length(found[i]) as past,
               secret[i] as value
        from (select *, unnest(range(1, len(found) + 1)) as i
              from (select doc_id, source, string_split_regex(text, '{pattern}') as pieces,
                           regexp_extract_all(text, '{pattern}', 0) as found,
                           regexp_extract_all(text, '{pattern}', {kind.group}) as secret
                    from documents where regexp_matches(text, '{pattern}')))
        where length(secret[i]) >= {kind.least}
        """

    listed = "string_agg(kind || ':' || first || ':' || past, ',' order by first, rank)"
    return f"""
    with s as ({" union all ".join(spans(rank, kind) for rank, kind in enumerate(secrets.KINDS))}),
         o as (select value, count(distinct coalesce(source, '-')) as owners from s group by value),
         v as (select value, case when owners >= {secrets.SHARED_OWNERS} then 'shared'
                                  when len(list_distinct(string_split(value, ''))) >= {secrets.RANDOM_CHARACTERS} then 'live'
                                  else 'weak' end as standing from o),
         d as (select doc_id, count(*) filter (where rank = 0) as n_assign, count(*) filter (where rank = 1) as n_access,
                      count(*) filter (where rank = 2) as n_hex, {listed} filter (where rank < 3) as base, {listed} as spans,
                      count(distinct value) filter (where standing = 'live') as n_live,
                      count(distinct value) filter (where standing = 'shared') as n_shared,
                      count(distinct value) filter (where standing = 'weak') as n_weak
               from s join v using (value) group by doc_id)
    select documents.doc_id, {", ".join(f"coalesce({n}, 0) as {n}" for n in ("n_assign", "n_access", "n_hex", "n_live", "n_shared", "n_weak"))},
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from documents left join d on d.doc_id = documents.doc_id"""


def sql_vector_codes() -> str:
    """Every part against every entry, round by round."""
    rounds = []
    for n in range(quantize.ROUNDS + 1):
        rounds.append(f"""
         a{n} as (select vec_id, label, part, v, least.entry, least.far from (
                  select p.vec_id, p.label, p.part, p.v, min({{'far': d.far, 'entry': d.entry}}) as least
                  from p join (select p.vec_id, b.entry, p.part,
                                      list_sum(list_transform(list_zip(p.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) as far
                               from p join b{n} b using (part)) d using (vec_id, part) group by all))""")
        if n < quantize.ROUNDS:
            rounds.append(f"""
         m{n} as (select part, entry, list(mean order by spot) as v from (
                  select part, entry, spot, cast(floor(sum(x) / count(*)) as bigint) as mean
                  from (select part, entry, unnest(v) as x, generate_subscripts(v, 1) as spot from a{n}) group by all) group by all),
         b{n + 1} as (select part, entry, coalesce(m.v, b.v) as v from b{n} b left join m{n} m using (part, entry))""")
    return f"""
    with k as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(cast(x as double) * {quantize.SCALE}) as bigint)) as v
               from embeddings where embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
         p as (select vec_id, label, part, v[part * len(v) // {quantize.PARTS} + 1 : (part + 1) * len(v) // {quantize.PARTS}] as v
               from k, range({quantize.PARTS}) r(part)),
         b0 as (select part, n - 1 as entry, v
                from (select part, v, row_number() over (partition by part order by vec_id) as n from p) where n <= {quantize.ENTRIES}),
         {",".join(rounds)},
         s as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from b{quantize.ROUNDS}),
         c as (select vec_id, label, string_agg(format('{{:02x}}', entry), '' order by part) as code,
                      cast(sum(far) as bigint) as error from a{quantize.ROUNDS} group by vec_id, label)
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from c, s"""


def sql_prefix_trie() -> str:
    """Every prefix of every rebuilt conversation as a list of turns; crc32 bit by bit."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, (s & 1) * 3988292384))"
    characters = "list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))"
    crc = f"xor(list_reduce(list_concat([4294967295], {characters}), lambda c, b: {bits}), 4294967295)"
    return f"""
    with o as (select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) as turns
               from conversations where conv_id is not null group by conv_id),
         h as (select *, {crc} % 6 as h from o),
         s as (select h.conv_id, list_concat(coalesce(f.turns[1:h.h], []), h.turns[h.h + 1:]) as turns
               from h left join o f on f.conv_id = h.conv_id - h.conv_id % 100),
         p as (select conv_id, depth, len(turns) = depth as ends, turns[1:depth] as path,
                      case when depth > 0 then turns[1:depth - 1] end as above
               from (select *, unnest(range(len(turns) + 1)) as depth from s)),
         n as (select path, depth, above, min(conv_id) as conv_id, count(*) as n_convs,
                      coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '') as ends
               from p group by all),
         c as (select above as path, count(*) as n_children from n where depth > 0 group by above),
         v as (select n.*, coalesce(n_children, 0) as n_children,
                      case when depth > 0 then (n_convs - 1) * length(path[depth]['t']) else 0 end as saved
               from n left join c using (path)),
         b as (select a.path, count(*) filter (where v.n_children = 0) as n_leaves, sum(v.saved) as saved
               from v join p a on a.conv_id = v.conv_id and a.depth <= v.depth group by a.path)
    select v.conv_id, cast(v.depth as bigint) as depth, u.conv_id as parent_conv_id, v.n_convs, v.n_children, b.n_leaves,
           cast(b.saved as bigint) as saved_tokens, sha256(v.ends) as ends_sha256
    from v join b using (path) left join n u on u.path = v.above"""


def oracle_sql() -> dict[str, str]:
    """Counterparts of the operators whose whole result SQL can express; the tests hold the others against brute force."""
    return {
        "op4_near_duplicates": f"""
            with recursive w as (select doc_id, {WORDS} as w from documents),
                 s as (select distinct doc_id, unnest(
                           case when len(w) < 4 then [array_to_string(w, ' ')]
                                else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as g
                       from w where len(w) > 0),
                 n as (select doc_id, count(*) as n from s group by doc_id),
                 c as (select a.doc_id as a, b.doc_id as b, count(*) as common
                       from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
                 l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b
                       where 100 * common >= 80 * (x.n + y.n - common)),
                 e as (select a, b from l union all select b, a from l),
                 r as (select doc_id, doc_id as reached from documents
                       union select r.doc_id, e.b from r join e on r.reached = e.a),
                 m as (select doc_id, min(reached) as component_id from r group by doc_id)
            select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, m.component_id,
                   d.doc_id = m.component_id as kept
            from documents d join m on m.doc_id = d.doc_id left join n on n.doc_id = d.doc_id""",
        "op8_secrets": sql_secrets(),
        "op11_vector_codes": sql_vector_codes(),
        "op13_prefix_trie": sql_prefix_trie(),
        "op10_warc": """
            with d as (select page_id, octet_length(encode(coalesce(html, ''))) as size, sha256(coalesce(html, '')) as digest
                       from pages),
                 f as (select digest, min(page_id) as first from d group by digest)
            select page_id, cast(size as bigint) as payload_bytes, digest as payload_digest,
                   case when size >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
                   case when size >= 100 and page_id <> first then first end as refers_to
            from d join f using (digest)""",
    }
