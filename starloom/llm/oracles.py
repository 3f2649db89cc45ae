"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from starloom.llm.mixing import LANES, SEED
from starloom.llm.sharding import HASH_BITS, SHARD_BYTES

_UNIT = "(('0x' || substr(md5({}), 1, 8))::bigint / 4294967296.0)::double"
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

#: The level at which targets stop is found by trying every source as the first that is free.
MIX = f"""
with sized as (
    select doc_id, source, coalesce(len({_WORDS}), 0)::bigint as size,
        floor({_UNIT.format("'lane|' || coalesce(doc_id::varchar, '~')")} * {LANES})::bigint as lane
    from documents
), named as (
    select source, sum(size)::bigint as source_size,
        (1 + (row_number() over (order by source nulls last) - 1) % 3)::bigint as weight
    from sized group by source
), levels as (
    select a.source, a.source_size, a.weight, (3 * a.source_size)::bigint as most,
        (select sum(source_size) from named) - coalesce(sum(3 * b.source_size) filter (
            3 * b.source_size::double / b.weight < 3 * a.source_size::double / a.weight
            or (3 * b.source_size::double / b.weight = 3 * a.source_size::double / a.weight and coalesce(b.source, '~~~~') < coalesce(a.source, '~~~~'))), 0) as left_words,
        (select sum(weight) from named) - coalesce(sum(b.weight) filter (
            3 * b.source_size::double / b.weight < 3 * a.source_size::double / a.weight
            or (3 * b.source_size::double / b.weight = 3 * a.source_size::double / a.weight and coalesce(b.source, '~~~~') < coalesce(a.source, '~~~~'))), 0) as left_weight
    from named a, named b group by all
), leveled as (
    select *, left_words::double / left_weight::double as level from levels
), chosen as (
    select min_by(level, most::double / weight) as level, min(most::double / weight) as limit_ratio
    from leveled where level * weight <= most
), targets as (
    select source, source_size, weight,
        case when most::double / weight < limit_ratio then most::double else chosen.level * weight end as target
    from leveled, chosen
), ranked as (
    select doc_id, sized.source, size, source_size, target,
        case when source_size > 0 then target / source_size else 0 end as expected,
        row_number() over (partition by sized.source order by size, lane, doc_id nulls first) - 1 as place,
        {_UNIT.format(f"'{SEED}|' || coalesce(sized.source, '~')")} as start
    from sized join targets on sized.source is not distinct from targets.source
)
select doc_id, size, source_size, target,
    least(floor(start + (place + 1) * expected) - floor(start + place * expected), 3)::bigint as copies,
    (least(floor(start + (place + 1) * expected) - floor(start + place * expected), 3) * size)::bigint as taken
from ranked
"""

SHARDS = f"""
with sized as (
    select row_number() over () as n, doc_id, coalesce(octet_length(encode(text)), 0)::bigint as n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, {HASH_BITS // 4}))::bigint as h
    from documents
), levels as (
    select sized.*, d.depth::int as depth, h >> ({HASH_BITS} - d.depth)::int as prefix
    from sized, range(0, 31) d(depth)
), buckets as (
    select depth, prefix, sum(n_bytes)::bigint as shard_size from levels group by depth, prefix
), fitting as (
    select n, doc_id, n_bytes, depth, prefix, shard_size,
        row_number() over (partition by n order by depth) as choice
    from levels join buckets using (depth, prefix) where shard_size <= {SHARD_BYTES}
)
select doc_id, n_bytes,
    case when depth = 0 then '' else right(repeat('0', 64) || bin(prefix), depth) end as shard_id,
    depth as shard_depth, shard_size
from fitting where choice = 1
"""

REPEATS = rf"""
with worded as (
    select row_number() over () as n, doc_id, coalesce({_WORDS}, []) as words from documents
), windows as (
    select n, unnest(range(1, len(words) - 33)) as start, words from worded where len(words) >= 35
), counted as (
    select n, start, count(*) over (partition by array_to_string(words[start : start + 34], ' ')) as found from windows
), covered as (
    select distinct n, start + k as place from counted, range(0, 35) r(k) where found > 1
), places as (
    select n, unnest(range(1, len(words) + 1)) as place, unnest(words) as word from worded
), kept as (
    select n, count(*) as n_kept, string_agg(word, ' ' order by place) as text
    from places anti join covered using (n, place) group by n
)
select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n_kept, 0))::bigint as n_removed,
    sha256(coalesce(text, '')) as kept_sha256
from worded left join kept using (n)
"""

PREFERENCES = """
with replies as (
    select conv_id, turn, min(text) as text from conversations
    where role = 'assistant' and turn is not null and conv_id is not null group by conv_id, turn
), final as (
    select conv_id, max(turn) as turn, arg_max(text, turn) as text from replies group by conv_id
), shared as (
    select f.conv_id, count(c.conv_id) as n,
        coalesce(string_agg('<|im_start|>' || coalesce(c.role, '') || chr(10) || coalesce(c.text, '') || '<|im_end|>' || chr(10), ''
            order by c.turn, c.role, c.text), '') as prompt
    from final f left join conversations c on c.conv_id = f.conv_id and c.turn < f.turn
    group by f.conv_id
), pairs as (
    select f.conv_id, shared.n, shared.prompt, f.text as own, g.text as other, g.conv_id is not null as paired
    from final f join shared using (conv_id) left join final g on g.conv_id = xor(f.conv_id, 1)
), told as (
    select *, paired and own is not distinct from other as equal,
        '<|im_start|>assistant' || chr(10) || coalesce(own, '') || '<|im_end|>' || chr(10) as own_turn,
        '<|im_start|>assistant' || chr(10) || coalesce(other, '') || '<|im_end|>' || chr(10) as other_turn
    from pairs
)
select conv_id as pair_id, (n + equal::int)::int as n_shared_turns,
    case when equal then prompt || own_turn else prompt end as prompt,
    case when equal then '' else own_turn end as chosen,
    case when equal then '' else '22-' || length(own_turn) end as chosen_spans,
    case when equal or not paired then '' else other_turn end as rejected,
    case when equal or not paired then '' else '22-' || length(other_turn) end as rejected_spans
from told
"""

LEAKS = rf"""
with items as (
    select item_id, {_WORDS.replace("text", "lower(text)", 1)} as words from benchmark
), item_shingles as (
    select item_id, len(words) as n, array_to_string(words[k : k + 4], ' ') as h, count(*) as times
    from (select item_id, words, unnest(range(1, len(words) - 3)) as k from items where len(words) >= 5) group by all
), docs as (
    select row_number() over () as r, doc_id, coalesce({_WORDS.replace("text", "lower(text)", 1)}, []) as words from documents
), doc_shingles as (
    select r, len(words) as n_doc, k - 1 as place, array_to_string(words[k : k + 4], ' ') as h
    from (select r, words, unnest(range(1, len(words) - 3)) as k from docs where len(words) >= 5)
), hits as (
    select r, item_id, n, h, times, place, n_doc, least(n, n_doc) as size from doc_shingles join item_shingles using (h)
), windows as (
    select r, item_id, n, size, h, times, unnest(range(greatest(0, place - size + 5), least(place, n_doc - size) + 1)) as start from hits
), found as (
    select r, item_id, n, size, start, h, least(count(*), times) as shared from windows group by r, item_id, n, size, start, h, times
), likeness as (
    select r, item_id, start, sum(shared) as shared, (n - 4) + (size - 4) - sum(shared) as total from found group by r, item_id, n, size, start
), leaks as (
    select r, item_id, max(floor(100 * shared / total))::int as best from likeness where 100 * shared >= 75 * total group by r, item_id
), by_doc as (
    select r, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id) as items, max(best) as best from leaks group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_items, 0)::bigint as n_items, coalesce(items, '') as items,
    coalesce(best, 0)::int as best_percent, by_doc.r is null as kept
from docs left join by_doc using (r)
"""

ORACLES: dict[str, str] = {
    "op1_preference_pairs": PREFERENCES,
    "op2_systematic_mix": MIX,
    "op5_extendible_shards": SHARDS,
    "op6_simhash_decontamination": LEAKS,
    "op9_count_min_repeats": REPEATS,
}
