"""Blocking, similarity and end-to-end fuzzy detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from dupelens.functions import sequences
from dupelens.functions.labels import status
from dupelens.operators import candidates, clustering, compare, pair_matrix, pair_space
from dupelens.plans import fuzzy_detection as fuzzy
from dupelens.plans import resumable
from dupelens.queries.views import with_views
from dupelens.runtime import fresh_path, materialize
from dupelens.sinks import tables
from dupelens.sources import fixtures
from dupelens.sources.fingerprints import usable

TOLERANCE = 5.0


def _texts(spark, sf):
    """The documents, dealt to all tasks: the given file is one split, and what follows is work per text."""
    return fixtures.spread(fixtures.table(spark, sf, "documents"))


def _records(documents, complete=True):
    """Usable records with their whole content; without ``complete`` some contents are missing."""
    media = fixtures.media_of_documents(documents)
    return usable(media.withColumn("fingerprint", F.md5("content"))).select(
        "asset_id", "file_key", "format", "source", "duration", "file_size", "fingerprint",
        (F.col("content") if complete else F.when(~fixtures.is_unreadable(), F.col("content"))).alias("content"),
    )


def _plain_records(spark, sf):
    return usable(fixtures.fingerprint(spark, sf))


def _durations(spark, sf):
    return clustering.Durations(_plain_records(spark, sf))


def _blocked(spark, sf, complete=True):
    # Texts are dealt to tasks as copies are brought together, and made into sequences then.
    records = _records(fixtures.table(spark, sf, "documents"), complete)
    return fuzzy.block(records, TOLERANCE, sequences.token_hashes("content"))


def _plain_blocked(spark, sf):
    return fuzzy.block(_plain_records(spark, sf), TOLERANCE).records


def _found(mode="all"):
    return lambda s, d: fuzzy.detect(_blocked(s, d), mode)


def _new_only(spark, sf):
    """Known pairs come from a stored table: each file of an exact group with the group's first file."""
    records = _plain_records(spark, sf)
    first = records.groupBy("fingerprint").agg(F.min(F.struct("asset_id", "file_key")).alias("first"))
    stored = records.join(first, "fingerprint").select(
        F.col("asset_id").alias("asset_id_1"), F.col("file_key").alias("file_key_1"),
        F.col("first.asset_id").alias("asset_id_2"), F.col("first.file_key").alias("file_key_2"),
    )
    path = fresh_path(spark, "stored-pairs")
    tables.append(stored, path)
    return fuzzy.detect(_blocked(spark, sf), known=spark.read.schema(stored.schema).parquet(path))


def _summary(spark, sf):
    blocked = _blocked(spark, sf, complete=False)
    return fuzzy.run_summary(blocked, fuzzy.compare(blocked))


def _errors(spark, sf):
    """Files that could not be compared go to a path of their own, beside the results."""
    path = fresh_path(spark, "duplicates")
    found = fuzzy.compare(_blocked(spark, sf, complete=False))
    tables.append(found.pairs, path, "json")
    tables.append(found.errors, f"{path}_errors", "json")
    return spark.read.schema(found.errors.schema).json(f"{path}_errors").drop("timestamp")


def _stopped(spark, sf):
    """A run that was stopped after two of its four batches: its records and its folder."""
    blocked, path = _blocked(spark, sf), fresh_path(spark, "run")
    resumable.run(blocked, path, batches=4, most_batches=2)
    return blocked, path


def _remaining(spark, sf):
    return resumable.remaining(*_stopped(spark, sf))


def _resumed(spark, sf):
    blocked, path = _stopped(spark, sf)
    resumable.run(blocked, path, batches=4)
    return resumable.pairs(spark, path)


def _matrix(spark, sf):
    blocked = _blocked(spark, sf)
    pairs = pair_matrix.unit_pairs(blocked.records, blocked.classes)
    same_version, same_format = F.col("source_1") == F.col("source_2"), F.col("format_1") == F.col("format_2")
    return pairs.select(
        "cluster_start", "fingerprint_1", "fingerprint_2", "source_1", "source_2", "format_1", "format_2", "similarity",
        status(F.col("similarity"), "version").alias("status"),
        (same_version & ~same_format).alias("same_version_diff_format"),
        (same_format & ~same_version).alias("same_format_diff_version"),
    )


def _scores(spark, sf):
    return candidates.similar_classes(_blocked(spark, sf).classes, 0.5).select(
        "cluster_start", "fingerprint_1", "fingerprint_2", "similarity"
    )


def _bit_tolerant(spark, sf):
    """Scores with up to two bit errors per value; every second value of the mp3 files has one or two bits turned."""
    media = fixtures.media_of_documents(fixtures.table(spark, sf, "documents"))
    words = sequences.token_values("content.text")
    turn = F.pmod(F.col("asset_id").cast("bigint"), F.lit(32)).alias("turn")
    one, other = (F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col("content.turn") + n, F.lit(32)).cast("int")) for n in (0, 7))
    turned = F.transform(
        words,
        lambda word, at: F.when(at % 4 == 0, word.bitwiseXOR(one)).when(at % 4 == 2, word.bitwiseXOR(one.bitwiseXOR(other))).otherwise(word),
    )
    # Text, format and turn are what the fingerprint is made of.
    content = F.struct(F.col("content").alias("text"), (F.col("format") == "mp3").alias("is_mp3"), turn)
    records = usable(media.withColumn("fingerprint", F.md5(F.concat_ws("-", "content", "format", turn)))).select(
        "duration", "fingerprint", content.alias("content")
    )
    blocked = fuzzy.block(records, TOLERANCE, F.when(F.col("content.is_mp3"), turned).otherwise(words))
    return candidates.similar_classes(blocked.classes, 0.75, max_bits=2).select(
        "cluster_start", "fingerprint_1", "fingerprint_2", "similarity"
    )


def _neighbours(frame, key, *columns):
    """Each row next to the row with the following key."""
    left = frame.select(F.col(key).alias("id_1"), *(F.col(c).alias(f"{c}_1") for c in columns))
    right = frame.select((F.col(key) - 1).alias("id_1"), F.col(key).alias("id_2"), *(F.col(c).alias(f"{c}_2") for c in columns))
    return left.join(right, "id_1")


def _bit_diff(spark, sf):
    docs = _texts(spark, sf).select("doc_id", sequences.token_values("text").alias("words"))
    pairs = _neighbours(docs, "doc_id", "words").withColumn("diff", sequences.bit_differences("words_1", "words_2"))
    return pairs.select("id_1", "id_2", *sequences.bit_diff_columns("diff"))


def _positional(spark, sf):
    docs = _texts(spark, sf).select("doc_id", sequences.token_hashes("text").alias("words"))
    pairs = _neighbours(docs, "doc_id", "words")
    shared = F.least(F.size("words_1"), F.size("words_2"))
    equal = F.zip_with(F.slice("words_1", 1, shared), F.slice("words_2", 1, shared), lambda a, b: a == b)
    return pairs.withColumn("equal", equal).select(
        "id_1",
        "id_2",
        F.size("equal").alias("shared_length"),
        F.size(F.filter("equal", lambda e: e)).alias("equal_positions"),
        F.array_position("equal", False).alias("first_different"),
    )


def _signals(spark, sf):
    pairs = _neighbours(fixtures.table(spark, sf, "embeddings"), "vec_id", "embedding")
    return sequences.signal_metrics(pairs, ["id_1", "id_2"], "embedding_1", "embedding_2")


def _token_fingerprint(spark, sf):
    docs = _texts(spark, sf).select("doc_id", sequences.token_values("text").alias("words"))
    return docs.select(
        "doc_id",
        F.size("words").alias("length"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda acc, w: acc + w).alias("value_sum"),
        F.array_min("words").alias("value_min"),
        F.array_max("words").alias("value_max"),
    )


def _documents(spark, sf):
    docs = fixtures.table(spark, sf, "documents")
    tags = F.create_map(
        F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"), F.lit("size"), F.col("n_chars").cast("string")
    )
    return docs.select(
        F.col("doc_id").alias("id"), "n_chars", compare.content_hash("text").alias("md5"),
        compare.normalised_hash("text").alias("sha256"), tags.alias("tags"),
    )


def _deep(spark, sf):
    docs = materialize(_documents(spark, sf), "document-hashes")
    first = materialize(docs.groupBy("n_chars").agg(F.min("id").alias("id_2")), "first-of-length")
    pairs = docs.select(F.col("id").alias("id_1"), "n_chars").join(first, "n_chars").where("id_1 <> id_2")
    return compare.deep_compare(pairs.select("id_1", "id_2"), docs)


def _tags(spark, sf):
    part = fixtures.table(spark, sf, "part")
    tags = F.map_filter(
        F.create_map(
            F.lit("brand"), F.col("p_brand"),
            F.lit("type"), F.when(F.col("p_type") != "PROMO", F.col("p_type")),
            F.lit("size"), F.when(F.col("p_size") > 10, F.col("p_size").cast("string")),
        ),
        lambda k, v: v.isNotNull(),
    )
    pairs = _neighbours(part.select("p_partkey", tags.alias("tags")), "p_partkey", "tags")
    return pairs.select("id_1", "id_2", F.inline(compare.tag_differences("tags_1", "tags_2")))


def _formats(spark, sf):
    records = _records(_texts(spark, sf)).withColumn("words", sequences.token_hashes("content"))
    return compare.format_comparison(records.drop("content"), "wav", "mp3")


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _robust(spark, sf):
    items = _texts(spark, sf).select(
        F.col("doc_id").alias("id"),
        sequences.token_hashes("text").alias("words"),
        sequences.token_hashes(F.translate("text", LETTERS, LETTERS.upper())).alias("recased"),
    )
    return compare.robustness(items, F.xxhash64(F.lit("~filler~")))


def _hash_groups(column):
    return lambda s, d: compare.hash_duplicates(_documents(s, d), column)


SPARK = {
    "anchored_clusters": lambda s, d: clustering.anchored_clusters(_durations(s, d), TOLERANCE),
    "gap_clusters": lambda s, d: clustering.gap_clusters(_durations(s, d), TOLERANCE),
    "blocking_reduction": lambda s, d: clustering.blocking_reduction(_durations(s, d), [5, 10, 20, 30, 50]),
    "duration_summary": lambda s, d: clustering.duration_summary(_plain_records(s, d)),
    "source_counts": lambda s, d: _plain_records(s, d).groupBy("source", "format").agg(F.count(F.lit(1)).alias("files")),
    "blocked_pairs": lambda s, d: pair_space.cluster_pairs(_plain_blocked(s, d)),
    "pair_skip_reasons": lambda s, d: pair_space.skip_reasons(pair_space.cluster_pairs(_plain_blocked(s, d))),
    "offset_vote_similarity": _scores,
    "fuzzy_duplicates": _found(),
    "pairs_all": lambda s, d: _found("all")(s, d).drop("duplicate_type"),
    "pairs_cross_source": lambda s, d: _found("cross-source")(s, d).drop("duplicate_type"),
    "pairs_same_source": lambda s, d: _found("same-source")(s, d).drop("duplicate_type"),
    "fuzzy_duplicates_new_only": _new_only,
    "detection_run_summary": _summary,
    "pair_errors": _errors,
    "bit_tolerant_similarity": _bit_tolerant,
    "resumed_detection": _resumed,
    "all_pairs_matrix": _matrix,
    "resume_remaining_clusters": _remaining,
    "token_fingerprint": _token_fingerprint,
    "sign_fingerprint": lambda s, d: fixtures.table(s, d, "embeddings").select(
        "vec_id", "label", sequences.sign_word("embedding").alias("word")
    ),
    "bit_diff_stats": _bit_diff,
    "positional_join": _positional,
    "signal_pair_metrics": _signals,
    "format_comparison": _formats,
    "robustness_ranking": _robust,
    "robustness_summary": lambda s, d: compare.robustness_summary(_robust(s, d)),
    "content_md5_duplicates": _hash_groups("md5"),
    "normalised_hash_duplicates": _hash_groups("sha256"),
    "tag_diff": _tags,
    "deep_compare": _deep,
}

USABLE = """usable as (select * from fingerprint
  where processing_status = 'SUCCESS' and fingerprint is not null and duration > 0)"""

# Anchored clusters: the next head is the lowest duration more than 5 above the head.
HEADS = (
    USABLE
    + """,
lengths as materialized (select distinct duration from usable),
heads(h) as (select min(duration) from lengths
             union all select (select min(duration) from lengths where duration > h + 5) from heads where h is not null),
placed as (select u.*, h as cluster_start from usable u asof join (select h from heads where h is not null) k on u.duration >= k.h),
clustered as (select * from placed
              where cluster_start in (select cluster_start from placed group by cluster_start having count(*) > 1))"""
)
GAPS = (
    USABLE
    + """,
marked as (select duration, n,
   case when lag(duration) over (order by duration) is null or duration > lag(duration) over (order by duration) + {tol}
        then duration end as mark
 from (select duration, count(*) as n from usable group by duration)),
islands as (select duration, n, max(mark) over (order by duration) as cluster_start from marked),
sized as (select *, sum(n) over (partition by cluster_start) as cluster_size from islands)"""
)

# Best-alignment scores of different content in one cluster, from the positions of equal tokens.
SCORES = (
    HEADS
    + """,
content as (select distinct c.cluster_start, c.fingerprint, string_split(lower(m.content), ' ') as words
            from clustered c join media m on m.asset_id = c.asset_id and m.file_key = c.file_key),
tokens as (select cluster_start, fingerprint, len(words) as length, unnest(words) as token, unnest(range(len(words))) as pos
           from content),
votes as (select a.cluster_start, a.fingerprint as fingerprint_1, b.fingerprint as fingerprint_2,
                 least(a.length, b.length) as shorter, a.pos - b.pos as shift, count(*) as hits
          from tokens a join tokens b on a.cluster_start = b.cluster_start and a.token = b.token
           and a.fingerprint < b.fingerprint and abs(a.pos - b.pos) <= 120
          group by all),
scores as (select cluster_start, fingerprint_1, fingerprint_2, max(hits) / any_value(shorter) as similarity
           from votes group by cluster_start, fingerprint_1, fingerprint_2)"""
)

# Every pair of files of different assets in one cluster, grouped by content, source and format.
UNITS = (
    SCORES
    + """,
unit_pairs as (
  select a.cluster_start, a.fingerprint as fingerprint_1, a.source as source_1, a.format as format_1,
         b.fingerprint as fingerprint_2, b.source as source_2, b.format as format_2, count(*) as file_pairs
  from clustered a join clustered b on a.cluster_start = b.cluster_start and a.asset_id <> b.asset_id
   and (a.fingerprint, a.source, a.format, a.file_key) < (b.fingerprint, b.source, b.format, b.file_key)
  group by all),
sizes as (select cluster_start, fingerprint, source, format, count(*) as files from clustered group by all),
found as (
  select p.*, f1.files as files_1, f2.files as files_2,
         case when p.fingerprint_1 = p.fingerprint_2 then 1.0::double else s.similarity end as similarity
  from unit_pairs p
  left join scores s using (cluster_start, fingerprint_1, fingerprint_2)
  join sizes f1 on f1.cluster_start = p.cluster_start and f1.fingerprint = p.fingerprint_1 and f1.source = p.source_1 and f1.format = p.format_1
  join sizes f2 on f2.cluster_start = p.cluster_start and f2.fingerprint = p.fingerprint_2 and f2.source = p.source_2 and f2.format = p.format_2
  where p.fingerprint_1 = p.fingerprint_2 or s.similarity >= 0.6),
labelled as (select *,
  case when similarity >= 0.95 then case when format_1 = format_2 and source_1 = source_2 then 'IDENTICAL'
                                         when source_1 = source_2 then 'SAME_CONTENT_DIFF_FORMAT' else 'CROSS_SOURCE_IDENTICAL' end
       when similarity >= 0.80 then case when source_1 = source_2 then 'HIGH_SIMILARITY_SAME_SOURCE' else 'HIGH_SIMILARITY_CROSS_SOURCE' end
       when similarity >= 0.60 then 'RELATED_VERSIONS' else 'LOW_SIMILARITY' end as duplicate_type
  from found)"""
)

# Every pair of files in one cluster, whatever its assets and its score.
ALL_UNITS = (
    UNITS.replace(" and a.asset_id <> b.asset_id\n", "\n")
    .replace("else s.similarity end as similarity", "else coalesce(s.similarity, 0) end as similarity")
    .replace("""
  where p.fingerprint_1 = p.fingerprint_2 or s.similarity >= 0.6),""", "),")
)

# Contents that cannot be read in any copy.
FAILED = """,
failed as (select cluster_start, fingerprint from clustered group by cluster_start, fingerprint
           having bool_and(format = 'mp3' and cast(asset_id as bigint) % 50 = 5))"""

# The same without the pairs of a file and the first file of its exact group.
NEW_UNITS = UNITS.replace(
    """   and (a.fingerprint, a.source, a.format, a.file_key) < (b.fingerprint, b.source, b.format, b.file_key)
""",
    """   and (a.fingerprint, a.source, a.format, a.file_key) < (b.fingerprint, b.source, b.format, b.file_key)
  where not exists (select 1 from first_files f where f.fingerprint = a.fingerprint and f.fingerprint = b.fingerprint
                      and ((f.asset_id, f.file_key) = (a.asset_id, a.file_key) or (f.asset_id, f.file_key) = (b.asset_id, b.file_key)))
""",
).replace(
    """
unit_pairs as (""",
    """
first_files as (select fingerprint, asset_id, file_key from usable
                qualify row_number() over (partition by fingerprint order by asset_id, file_key) = 1),
unit_pairs as (""",
)

# Pairs of files in one cluster, made one by one.
FILE_PAIRS = (
    HEADS
    + """,
file_pairs as (select a.cluster_start, a.source = b.source as same_source, a.file_key = b.file_key as same_file,
                      a.asset_id = b.asset_id as same_asset
               from clustered a join clustered b on a.cluster_start = b.cluster_start
                and (a.asset_id, a.file_key) < (b.asset_id, b.file_key))"""
)
NEIGHBOUR_WORDS = """docs as (select doc_id, string_split(lower(text), ' ') as tokens from documents),
pairs as (select a.doc_id as id_1, b.doc_id as id_2, a.tokens as t1, b.tokens as t2, least(len(a.tokens), len(b.tokens)) as shared
          from docs a join docs b on b.doc_id = a.doc_id + 1)"""


def _clustered(body: str, cte: str = HEADS, views: str = "fingerprint") -> str:
    return with_views(views, body, cte, recursive=True)


def _unit_sql(where: str = "", columns: str = "", cte: str = UNITS) -> str:
    return _clustered(
        f"""select cluster_start, fingerprint_1, source_1, format_1, fingerprint_2, source_2, format_2, similarity,
            {columns} files_1, files_2, file_pairs from labelled {where}""",
        cte,
    )


ROBUST = """with docs as (select doc_id as id, text, string_split(lower(text), ' ') as w, len(w) as n, n // 2 - 5 as m from documents),
      versions as (
        select id, n, 0 as created, 'exact_copy' as modification, w as altered from docs
        union all select id, n, 1, 'trim_start', w[11:] from docs where n > 10
        union all select id, n, 2, 'trim_end', w[:n - 10] from docs where n > 20
        union all select id, n, 3, 'trim_middle', list_concat(w[:m], w[m + 11:]) from docs where n > 30
        union all select id, n, 4, 'drop_tokens', list_filter(w, lambda t, i: i % 11 <> 0) from docs where n > 10
        union all select id, n, 5, 'repeat_tokens', flatten(list_transform(w, lambda t, i: case when i % 10 = 0 then [t, t] else [t] end)) from docs
        union all select id, n, 7, 'change_case', string_split(lower(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')), ' ') from docs
        union all select id, n, 6, 'insert_start', list_concat(['~filler~', '~filler~', '~filler~', '~filler~', '~filler~'], w) from docs),
      a as (select id, unnest(w) as t, unnest(range(n)) as pos from docs),
      b as (select id, n, created, modification, len(altered) as k, unnest(altered) as t, unnest(range(len(altered))) as pos from versions),
      votes as (select b.id, created, modification, n, k, a.pos - b.pos as shift, count(*) as hits
                from a join b on a.id = b.id and a.t = b.t and abs(a.pos - b.pos) <= 120 group by all),
      scored as (select v.id, v.created, v.modification, len(v.altered) - v.n as length_change,
                        coalesce(s.hits, 0) / least(v.n, len(v.altered)) as similarity
                 from versions v left join (select id, created, max(hits) as hits from votes group by id, created) s using (id, created))
"""

SQL = {
    "anchored_clusters": _clustered(
        """select duration, count(*) as n, cluster_start, any_value(cluster_size) as cluster_size
           from (select *, count(*) over (partition by cluster_start) as cluster_size from clustered)
           group by duration, cluster_start"""
    ),
    "gap_clusters": with_views(
        "fingerprint",
        "select duration, n, cluster_start, cluster_size::bigint as cluster_size from sized where cluster_size > 1",
        GAPS.format(tol=5),
    ),
    "blocking_reduction": with_views(
        "fingerprint",
        "select tolerance, clusters, comparisons, naive_comparisons, (1 - comparisons / naive_comparisons) * 100 as reduction_pct from ("
        + " union all ".join(
            f"""select {tol}::double as tolerance,
              (select count(distinct cluster_start) from sized_{tol} where cluster_size > 1) as clusters,
              (select coalesce(sum(s * (s - 1) // 2), 0)::bigint from (select cluster_start, sum(n)::bigint as s from sized_{tol} group by cluster_start)) as comparisons,
              (select count(*) * (count(*) - 1) // 2 from usable) as naive_comparisons"""
            for tol in (5, 10, 20, 30, 50)
        )
        + ")",
        USABLE
        + "".join(
            f""",
marked_{tol} as (select duration, n,
   case when lag(duration) over (order by duration) is null or duration > lag(duration) over (order by duration) + {tol}
        then duration end as mark
 from (select duration, count(*) as n from usable group by duration)),
islands_{tol} as (select duration, n, max(mark) over (order by duration) as cluster_start from marked_{tol}),
sized_{tol} as (select *, sum(n) over (partition by cluster_start) as cluster_size from islands_{tol})"""
            for tol in (5, 10, 20, 30, 50)
        ),
    ),
    "duration_summary": with_views(
        "fingerprint",
        """select files, shortest, longest, longest - shortest as duration_range, (longest - shortest) / files as average_gap,
             greatest(10.0::double, (longest - shortest) / files * 2) as suggested_tolerance
           from (select count(*) as files, min(duration) as shortest, max(duration) as longest from usable)""",
        USABLE,
    ),
    "source_counts": with_views(
        "fingerprint", "select source, format, count(*) as files from usable group by source, format", USABLE
    ),
    "blocked_pairs": _clustered(
        """select s.cluster_start, s.records, coalesce(pairs_all, 0) as pairs_all, coalesce(pairs_cross_source, 0) as pairs_cross_source,
             coalesce(pairs_same_source, 0) as pairs_same_source, coalesce(skipped_same_file, 0) as skipped_same_file,
             coalesce(skipped_same_asset, 0) as skipped_same_asset, coalesce(compared, 0) as compared
           from (select cluster_start, count(*) as records from clustered group by cluster_start) s
           left join (select cluster_start, count(*) filter (not same_file) as pairs_all,
               count(*) filter (not same_file and not same_source) as pairs_cross_source,
               count(*) filter (not same_file and same_source) as pairs_same_source,
               count(*) filter (same_file) as skipped_same_file,
               count(*) filter (not same_file and same_asset) as skipped_same_asset,
               count(*) filter (not same_file and not same_asset) as compared
             from file_pairs group by cluster_start) p using (cluster_start)""",
        FILE_PAIRS,
    ),
    "pair_skip_reasons": _clustered(
        """select reason, pairs from (select count(*) filter (same_file) as a, count(*) filter (not same_file and same_asset) as b,
             count(*) filter (not same_file and not same_asset) as c from file_pairs),
           lateral (values ('same_file', a), ('same_asset', b), ('compared', c)) v(reason, pairs)""",
        FILE_PAIRS,
    ),
    "offset_vote_similarity": _clustered(
        "select cluster_start, fingerprint_1, fingerprint_2, similarity from scores where similarity >= 0.5", SCORES
    ),
    "fuzzy_duplicates": _unit_sql("", "duplicate_type,"),
    "pairs_all": _unit_sql(),
    "pairs_cross_source": _unit_sql("where source_1 <> source_2"),
    "pairs_same_source": _unit_sql("where source_1 = source_2"),
    "fuzzy_duplicates_new_only": _unit_sql("", "duplicate_type,", NEW_UNITS),
    "resumed_detection": _unit_sql("", "duplicate_type,"),
    "detection_run_summary": _clustered(
        """select songs, clusters, comparisons, skipped, errors, duplicates,
             round((1 - comparisons / (songs * (songs - 1) // 2)) * 100, 6) as efficiency_pct
           from (select (select count(*) from usable) as songs,
             (select count(distinct cluster_start) from clustered) as clusters,
             (select count(*) from clustered a join clustered b on a.cluster_start = b.cluster_start
                and a.file_key < b.file_key and a.asset_id <> b.asset_id) as comparisons,
             (select count(*) from clustered a join clustered b on a.cluster_start = b.cluster_start
                and a.file_key < b.file_key and a.asset_id = b.asset_id) as skipped,
             (select count(*) from clustered a join clustered b on a.cluster_start = b.cluster_start
                and a.file_key < b.file_key and a.asset_id <> b.asset_id
              where exists (select 1 from failed f where f.cluster_start = a.cluster_start and f.fingerprint in (a.fingerprint, b.fingerprint))) as errors,
             (select sum(file_pairs)::bigint from labelled p
              where not exists (select 1 from failed f where f.cluster_start = p.cluster_start
                                  and f.fingerprint in (p.fingerprint_1, p.fingerprint_2))) as duplicates)""",
        UNITS + FAILED,
    ),
    "pair_errors": _clustered(
        """select 'comparison_returned_none' as error_type, 'no content to compare' as error_message, cluster_start, asset_id, file_key,
             fingerprint, format, source, duration, comparisons
           from (select c.*, (select count(*) from clustered o where o.cluster_start = c.cluster_start and o.asset_id <> c.asset_id) as comparisons
                 from clustered c join failed using (cluster_start, fingerprint))
           where comparisons > 0""",
        HEADS + FAILED,
    ),
    "bit_tolerant_similarity": _clustered(
        """select cluster_start, fingerprint_1, fingerprint_2, max(hits) / any_value(shorter) as similarity
           from votes group by cluster_start, fingerprint_1, fingerprint_2 having max(hits) / any_value(shorter) >= 0.75""",
        HEADS
        + """,
starts as (select distinct duration, cluster_start from clustered),
content as (select distinct s.cluster_start, md5(concat_ws('-', m.content, m.format, cast(m.asset_id as bigint) % 32)) as fingerprint,
              cast(m.asset_id as bigint) as id, m.format, string_split(lower(m.content), ' ') as words
            from media m join starts s using (duration) where m.processing_status = 'SUCCESS'),
single as (select cluster_start, fingerprint, min(id) as id, any_value(format) as format, any_value(words) as words from content group by 1, 2),
tokens as (select cluster_start, fingerprint, id, format, len(words) as length, unnest(words) as token, unnest(range(len(words))) as pos from single),
numbers as (select cluster_start, fingerprint, length, pos, case when format <> 'mp3' then v when pos % 4 = 0 then xor(v, one)
              when pos % 4 = 2 then xor(v, xor(one, other)) else v end as value
            from (select *, ('0x' || substr(md5(token), 1, 8))::bigint as v, (1::bigint << (id % 32)::int) as one,
                         (1::bigint << ((id + 7) % 32)::int) as other from tokens)),
-- Two of 32 bits differ in at most two of three blocks of bits: one block is equal.
blocks as (select *, unnest([0, 1, 2]) as block, unnest([value & 1023, (value >> 10) & 2047, value >> 21]) as bits from numbers),
votes as (select a.cluster_start, a.fingerprint as fingerprint_1, b.fingerprint as fingerprint_2, least(a.length, b.length) as shorter,
                 a.pos - b.pos as shift, count(distinct a.pos) as hits
          from blocks a join blocks b on a.cluster_start = b.cluster_start and a.block = b.block and a.bits = b.bits
            and a.fingerprint < b.fingerprint and abs(a.pos - b.pos) <= 120 and bit_count(xor(a.value, b.value)) <= 2
          group by all)""",
        "fingerprint media",
    ),
    "all_pairs_matrix": _clustered(
        """select cluster_start, fingerprint_1, fingerprint_2, source_1, source_2, format_1, format_2, similarity,
             case when similarity >= 0.95 then '🎯 NEARLY IDENTICAL' when similarity >= 0.80 then '🔍 VERY SIMILAR'
                  when similarity >= 0.50 then '📊 SIMILAR' when similarity >= 0.20 then '📈 SOMEWHAT SIMILAR' else '❌ DIFFERENT' end as status,
             source_1 = source_2 and format_1 <> format_2 as same_version_diff_format,
             format_1 = format_2 and source_1 <> source_2 as same_format_diff_version
           from labelled""",
        ALL_UNITS,
    ),
    "resume_remaining_clusters": _clustered(
        """select cluster_start, records from dealt
           where batch not in (select distinct batch from dealt order by batch limit 2)""",
        HEADS
        + """,
dealt as (select cluster_start, count(*) as records, any_value(('0x' || substr(md5(cast(floor(cluster_start)::bigint as varchar)), 1, 8))::bigint % 4) as batch
          from clustered group by cluster_start)""",
    ),
    "token_fingerprint": """select doc_id, len(w)::integer as length, list_sum(w)::bigint as value_sum, list_min(w) as value_min, list_max(w) as value_max
      from (select doc_id, list_transform(string_split(lower(text), ' '), lambda t: ('0x' || substr(md5(t), 1, 8))::bigint) as w from documents)""",
    "sign_fingerprint": """select vec_id, label,
        list_sum([case when embedding[i + 1] >= 0 then (case when i = 63 then (-9223372036854775808)::hugeint
                 else (1::bigint << i)::hugeint end) else 0::hugeint end for i in range(0, 64)])::bigint as word
      from embeddings""",
    "bit_diff_stats": "with " + NEIGHBOUR_WORDS + """,
      values_of as (select id_1, id_2, len(t1) as n1, len(t2) as n2, shared, unnest(range(shared)) as pos,
                      unnest(t1[1:shared]) as a, unnest(t2[1:shared]) as b from pairs),
      bits as (select *, bit_count(xor(('0x' || substr(md5(a), 1, 8))::bigint, ('0x' || substr(md5(b), 1, 8))::bigint)) as d from values_of)
      select id_1, id_2, any_value(shared)::integer as min_length, any_value(greatest(n1, n2))::integer as max_length,
        any_value(greatest(n1, n2) - shared)::integer as length_difference,
        (count(*) filter (d = 0))::integer as matching_values, (count(*) filter (d > 0))::integer as different_values,
        (count(*) filter (d = 0)) / count(*) as value_match_ratio, 1 - sum(d) / (count(*) * 32) as bit_similarity,
        sum(d)::bigint as total_bit_differences,
        coalesce(sum(d) / nullif(count(*) filter (d > 0), 0), 0.0)::double as avg_bit_differences_per_value,
        coalesce(array_to_string((list(pos order by pos) filter (d > 0))[1:10], ','), '') as first_10_differences
      from bits group by id_1, id_2""",
    "positional_join": "with " + NEIGHBOUR_WORDS + """,
      aligned as (select id_1, id_2, shared, list_transform(range(shared), lambda i: t1[i + 1] = t2[i + 1]) as equal from pairs)
      select id_1, id_2, shared::integer as shared_length, len(list_filter(equal, lambda e: e))::integer as equal_positions,
        coalesce(list_position(equal, false), 0)::bigint as first_different from aligned""",
    "signal_pair_metrics": """with samples as (
        select a.vec_id as id_1, b.vec_id as id_2, unnest(range(64)) as pos,
               unnest(a.embedding)::double as x, unnest(b.embedding)::double as y
        from embeddings a join embeddings b on b.vec_id = a.vec_id + 1)
      select id_1, id_2, count(*) as shared_length, (min(pos) filter (abs(x - y) > 0.01))::integer as first_difference,
        round(corr(x, y), 6) as correlation, round(max(abs(x - y)), 6) as max_difference,
        case when max(abs(x - y)) < 1e-4 then 'IDENTICAL' else 'DIFFERENT' end as verdict
      from samples group by id_1, id_2""",
    "format_comparison": with_views(
        "media",
        """select f.asset_id, f.source, v.similarity,
             case when similarity >= 0.95 then '🎯 NEARLY IDENTICAL - Same audio content in different formats'
                  when similarity >= 0.80 then '🔍 VERY SIMILAR - Likely same content with format differences'
                  when similarity >= 0.50 then '📊 SIMILAR - Related content but noticeable differences'
                  when similarity >= 0.10 then '📈 SOMEWHAT SIMILAR - Some common elements'
                  else '❌ DIFFERENT - Completely different audio content' end as status,
             abs(d1 - d2) as duration_diff, s1 / s2 as size_ratio, abs(n1 - n2)::integer as length_diff
           from formats f join (select asset_id, max(hits) / any_value(least(n1, n2)) as similarity from votes group by asset_id) v using (asset_id)""",
        """formats as (select w.asset_id, w.source, w.duration as d1, m.duration as d2, w.file_size as s1, m.file_size as s2,
             string_split(lower(w.content), ' ') as t1, string_split(lower(m.content), ' ') as t2, len(t1) as n1, len(t2) as n2
           from media w join media m on w.asset_id = m.asset_id and w.format = 'wav' and m.format = 'mp3'
           where w.processing_status = 'SUCCESS'),
         p1 as (select asset_id, n1, n2, unnest(t1) as t, unnest(range(n1)) as pos from formats),
         p2 as (select asset_id, unnest(t2) as t, unnest(range(n2)) as pos from formats),
         votes as (select p1.asset_id, n1, n2, p1.pos - p2.pos as shift, count(*) as hits
                   from p1 join p2 on p1.asset_id = p2.asset_id and p1.t = p2.t and abs(p1.pos - p2.pos) <= 120 group by all)""",
    ),
    "robustness_ranking": ROBUST + """select id, modification, similarity, length_change::integer as length_change,
        row_number() over (partition by id order by similarity desc, created)::integer as rank from scored""",
    "robustness_summary": ROBUST
    + """select modification, count(*) as versions, round(avg(similarity), 9) as mean_similarity, min(similarity) as least_similarity,
         max(similarity) as greatest_similarity from scored group by 1""",
    "content_md5_duplicates": "select md5(text) as md5, count(*) as copies from documents group by 1 having count(*) > 1",
    "normalised_hash_duplicates": """select sha256(regexp_replace(lower(trim(text)), '\\s+', ' ', 'g')) as sha256, count(*) as copies
      from documents group by 1 having count(*) > 1""",
    "tag_diff": """with tags as (select p_partkey as id, unnest(['brand', 'type', 'size']) as tag,
          unnest([p_brand, case when p_type <> 'PROMO' then p_type end, case when p_size > 10 then cast(p_size as varchar) end]) as value from part),
        present as (select * from tags where value is not null),
        pairs as (select a.p_partkey as id_1, b.p_partkey as id_2 from part a join part b on b.p_partkey = a.p_partkey + 1),
        l as (select id_1, id_2, tag, value from pairs join present on id = id_1),
        r as (select id_1, id_2, tag, value from pairs join present on id = id_2)
      select id_1, id_2, tag, coalesce(l.value, 'N/A') as value_1, coalesce(r.value, 'N/A') as value_2
      from l full outer join r using (id_1, id_2, tag) where coalesce(l.value, 'N/A') <> coalesce(r.value, 'N/A')""",
    "deep_compare": """with h as (select doc_id as id, n_chars, md5(text) as m, sha256(regexp_replace(lower(trim(text)), '\\s+', ' ', 'g')) as s, lang, source from documents),
        first as (select n_chars, min(id) as id_2 from h group by n_chars)
      select a.id as id_1, b.id as id_2, a.m = b.m as same_bytes, a.s = b.s as same_content,
        concat_ws(',', case when a.lang <> b.lang then 'lang' end, case when a.source <> b.source then 'source' end) as differing_tags,
        case when a.m = b.m then 'IDENTICAL_BYTES' when a.s = b.s then 'IDENTICAL_CONTENT' else 'DIFFERENT' end as verdict
      from h a join first f on f.n_chars = a.n_chars and f.id_2 <> a.id join h b on b.id = f.id_2""",
}
