"""The fixture views of ``dupelens.sources.fixtures`` as SQL, for the side-by-side check."""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "asset": (
        (),
        """select cast(c_custkey as varchar) as asset_id,
                  case when c_custkey % 2 = 0 then 1 else 3 end as product_indicator,
                  case when c_nationkey < 20 then 'Music' else 'Sfx' end as asset_type,
                  concat(lower(c_mktsegment), case when c_nationkey % 3 = 0 then ' Music' else ' fx' end) as asset_sub_type,
                  case when c_acctbal > 0 then 'ON_AIR' else 'OFF' end as last_status_group,
                  c_acctbal as balance
           from customer""",
    ),
    "asset_map": ((), "select o_orderkey as id, cast(o_custkey as varchar) as externalid from orders"),
    "asset_file": (
        (),
        """select l_orderkey as songid,
                  concat(l_partkey, '-', l_suppkey, '-', l_linenumber, '-', l_orderkey) as filekey,
                  case l_returnflag when 'A' then 'CORE' when 'N' then 'MP3' else 'STEM' end as role,
                  l_shipdate as createdat,
                  case when l_discount <= 0.05::double then 1 else 2 end as resolution_format,
                  l_linestatus, l_quantity
           from lineitem""",
    ),
    "asset_format": (
        (),
        "select cast(s_suppkey as varchar) as product_id, s_nationkey % 4 as format_id from supplier",
    ),
    "processed": (
        ("asset_map", "asset_file"),
        """select m.externalid as asset_id, f.filekey as file_key,
                  max(case when f.l_quantity < 10 then 1 else 0 end) as any_error
           from asset_file f join asset_map m on m.id = f.songid
           where f.l_linestatus = 'F' group by m.externalid, f.filekey""",
    ),
    "media": (
        (),
        """select cast(doc_id as varchar) as asset_id, concat(doc_id, '-', f.format) as file_key, f.format as format,
                  cast(n_chars as double) as duration, n_chars as file_size,
                  case when doc_id % 2 = 0 then 'catalog_a' else 'catalog_b' end as source,
                  case when n_chars < 64 then 'ERROR' else 'SUCCESS' end as processing_status,
                  case when f.format = 'mp3' and doc_id % 5 = 0 then concat(text, '#mp3') else text end as content
           from documents, (values ('wav'), ('mp3')) as f(format)""",
    ),
    "fingerprint": (
        ("media",),
        """select asset_id, file_key, format, duration, md5(content) as fingerprint, file_size, source, processing_status
           from media""",
    ),
    "pairs": (
        (),
        """select cast(o_custkey as varchar) as asset_id_1, cast(o_orderkey // 10 as varchar) as asset_id_2,
                  concat(o_custkey, '-', o_orderkey) as file_key_1,
                  concat(o_orderkey // 10, '-', o_orderkey, '-b') as file_key_2,
                  case when o_custkey % 2 = 0 then 'catalog_a' else 'catalog_b' end as source_1,
                  case when (o_orderkey // 10) % 2 = 0 then 'catalog_a' else 'catalog_b' end as source_2,
                  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'wav' else 'mp3' end as format_1,
                  case when o_orderstatus = 'F' then 'wav' else 'mp3' end as format_2,
                  cast(floor(o_totalprice / 1000.0::double) as double) as duration_1,
                  cast(floor(o_totalprice / 1000.0::double) as double) + cast(o_orderkey % 7 as double) as duration_2,
                  least(1.0::double, cast(floor(o_totalprice / 450.0::double) as double) / 1000.0::double) as similarity
           from orders""",
    ),
    "uploads": (
        (),
        """select cast(user_id as varchar) as asset_id, cast(event_id as varchar) as file_key,
                  case when user_id % 2 = 0 then 'catalog_a' else 'catalog_b' end as source,
                  cast(floor(value * 500.0::double) as bigint) as file_size,
                  case when event_type <> 'error' then value * 40.0::double - 200.0::double end as duration,
                  case when event_type = 'signup' then props when event_type = 'purchase' and value < 20 then null
                       else concat(props, event_type) end as fingerprint,
                  case event_type when 'click' then 'audio/mpeg' when 'view' then 'Application/WAV' when 'purchase' then 'text/html' end as content_type,
                  ts as created_at
           from events""",
    ),
    "validated": (
        ("uploads",),
        """select *, case when error_message is null then 'SUCCESS' else 'ERROR' end as processing_status from (
             select *, case when file_size < 1024 then concat('File too small (', file_size, ' bytes)')
                            when duration is null or duration <= 0 then 'Invalid duration'
                            when fingerprint is null then 'No fingerprint generated'
                            when length(fingerprint) < 10 then 'Fingerprint too short' end as error_message,
               concat_ws(',', case when content_type <> '' and not (lower(content_type) like '%audio%' or lower(content_type) like '%mpeg%'
                                        or lower(content_type) like '%wav%' or lower(content_type) like '%flac%') then 'unexpected content type' end,
                 case when file_size >= 1024 and file_size < 10240 then 'suspiciously small' end,
                 case when duration > 0 and duration < 1 then 'very short' end,
                 case when duration > 3600 then 'very long' end) as warnings
             from uploads)""",
    ),
}


def with_views(names: str, body: str, extra: str = "", recursive: bool = False) -> str:
    """``body`` preceded by the named views, their dependencies and any ``extra`` CTE text."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for parent in VIEWS[name][0]:
            need(parent)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        need(name)
    ctes = [f"{name} as ({VIEWS[name][1]})" for name in wanted]
    if extra:
        ctes.append(extra.strip().rstrip(","))
    head = "with recursive " if recursive else "with "
    return (head + ",\n".join(ctes) + "\n" if ctes else "") + body
