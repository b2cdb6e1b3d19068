"""The expected result of each query, as plain SQL over the same tables.

States are written as SELECTs: what a row looks like after a merge or a cycle.
"""

from __future__ import annotations

from lakestrata.plans.music import ALBUMS, ARTISTS, DIM_ALBUMS, DIM_ARTISTS, FACT_SONGS, SONGS
from registry import feeds

T1, T2 = "timestamp '2024-02-01 00:00:00'", "timestamp '2024-02-02 00:00:00'"
D1, D2 = "date '2024-02-01'", "date '2024-02-02'"
TOKENS = "('NULL','null','N/A','')"


def _clean(columns, source):
    cols = ", ".join(f"case when {c} in {TOKENS} then null else {c} end {c}" for c in columns)
    return f"select {cols} from ({source}) f"


def _raw(entity, text, at=T1):
    return f"select *, {at} _load_timestamp from ({_clean(entity.columns, text)}) r"


def _flag(*rules):
    return "case " + " ".join(f"when {c} then '{f}'" for f, c in rules) + " else 'VALID' end"


DATE = "cast(try_strptime(album_release_date,'%Y-%m-%d') as date)"
ANY_DATE = (
    f"coalesce({DATE}, cast(try_strptime(album_release_date,'%m/%d/%Y') as date))"
)
MS = "cast(try_cast(song_duration as decimal(38,0)) as bigint)"
ADDED = "try_strptime(song_added,'%Y-%m-%d %H:%M:%S')"
SONG_VALUES = f"""trim(song_id) song_id, trim(song_name) song_name, {MS} song_duration_ms,
  {MS}//60000 duration_minutes, ({MS}%60000+500)//1000 duration_seconds,
  trim(song_url) song_url, {ADDED} song_added_timestamp, cast({ADDED} as date) song_added_date,
  trim(album_id) album_id, trim(artist_id) artist_id"""
SONG_RULES = (
    ("MISSING_SONG_ID", "song_id is null"),
    ("INVALID_DURATION", f"{MS} is null"),
    ("INVALID_DATE", f"{ADDED} is null"),
    ("MISSING_ALBUM_ID", "album_id is null"),
    ("MISSING_ARTIST_ID", "artist_id is null"),
)


def stg_songs(text, delta=False, at=T1):
    flag = _flag(*(SONG_RULES[:2] if delta else SONG_RULES))
    return f"""select {SONG_VALUES}, {flag} data_quality_flag, _load_timestamp,
      {at} _transform_timestamp from ({_raw(SONGS, text, at)}) r"""


def stg_artists(text, delta=False, at=T1):
    name = "MISSING_ARTIST_NAME" if delta else "MISSING_NAME"
    flag = _flag(("MISSING_ARTIST_ID", "artist_id is null"), (name, "artist_name is null"))
    return f"""select trim(artist_id) artist_id, trim(artist_name) artist_name,
      trim(external_url) external_url, {flag} data_quality_flag, _load_timestamp,
      {at} _transform_timestamp from ({_raw(ARTISTS, text, at)}) r"""


def stg_albums(text, delta=False, at=T1):
    day, name = (ANY_DATE, "INVALID_RELEASE_DATE") if delta else (DATE, "INVALID_DATE")
    flag = _flag(("MISSING_ALBUM_ID", "album_id is null"), (name, f"{ANY_DATE} is null"))
    return f"""select trim(album_id) album_id, trim(album_name) album_name,
      {day} album_release_date,
      cast(try_cast(album_total_tracks as decimal(38,0)) as bigint) album_total_tracks,
      trim(album_url) album_url, year({day}) release_year, {flag} data_quality_flag,
      _load_timestamp, {at} _transform_timestamp from ({_raw(ALBUMS, text, at)}) r"""


def _differs(a, b, columns):
    return " or ".join(f"coalesce({a}.{c} <> {b}.{c}, false)" for c in columns)


def first_dim(spec, staged):
    values = ", ".join(spec.attributes)
    return f"""select row_number() over (order by {spec.key}) {spec.surrogate},
      {spec.key}, {values}, {D1} eff_start_date, cast(null as date) eff_end_date,
      true is_current, {T1} created_at, {T1} updated_at
      from ({staged}) s where data_quality_flag='VALID'"""


def next_dim(spec, dim, staged, compare=None, missing=True, reopen=True):
    """``dim`` and ``staged`` are names of common table expressions."""
    key, sk = spec.key, spec.surrogate
    values = ", ".join(spec.attributes)
    compare = compare or spec.compare
    gone = f"{key} not in (select {key} from {staged})" if missing else "false"
    fresh = f"{key} not in (select {key} from {dim} where is_current)"
    if reopen:
        fresh += f" or {key} in (select {key} from chg)"
    return f"""
      (with chg as (select d.{sk}, d.{key} from {dim} d join {staged} s on d.{key}=s.{key}
                    where d.is_current and s.data_quality_flag='VALID'
                      and ({_differs("d", "s", compare)})),
        closing as (select {sk} from chg union
                    select {sk} from {dim} where is_current and {gone})
      select {sk}, {key}, {values}, eff_start_date,
        case when {sk} in (select {sk} from closing) then {D2} - 1 else eff_end_date end
          eff_end_date,
        is_current and {sk} not in (select {sk} from closing) is_current, created_at,
        case when {sk} in (select {sk} from closing) then {T2} else updated_at end updated_at
      from {dim}
      union all
      select (select max({sk}) from {dim}) + row_number() over (order by {key}),
        {key}, {values}, {D2}, cast(null as date), true, {T2}, {T2}
      from {staged} where data_quality_flag='VALID' and ({fresh}))"""


FACT_COLUMNS = """song_sk, song_id, artist_sk, album_sk, song_name, song_duration_ms,
  duration_minutes, duration_seconds, song_url, song_added_timestamp, song_added_date,
  _load_timestamp, _source_file, is_valid"""


def looked_up(staged, artists="a1", albums="l1"):
    return f"""select s.*, a.artist_sk, l.album_sk from {staged} s
      left join {artists} a on s.artist_id=a.artist_id and a.is_current
      left join {albums} l on s.album_id=l.album_id and l.is_current"""


FIRST_FACT = f"""select row_number() over (order by song_id) song_sk, song_id, artist_sk,
  album_sk, song_name, song_duration_ms, duration_minutes, duration_seconds, song_url,
  song_added_timestamp, song_added_date, {T1} _load_timestamp,
  '2024-02-01 00:00:00.000' _source_file, song_duration_ms%5<>0 is_valid
  from ({looked_up("s1")}) s where data_quality_flag='VALID'"""


def ctes(**parts):
    return "with " + ", ".join(f"{name} as ({text})" for name, text in parts.items()) + " "


STATE = {
    "s1": stg_songs(feeds.SONGS_V1_KEYED),
    "a1": first_dim(DIM_ARTISTS, stg_artists(feeds.ARTISTS_V1_KEYED)),
    "l1": first_dim(DIM_ALBUMS, stg_albums(feeds.ALBUMS_V1_KEYED)),
}
FACT = {**STATE, "f1": FIRST_FACT}
NEXT = {
    "s2": stg_songs(feeds.SONGS_V2_KEYED, True, T2),
    "as2": stg_artists(feeds.ARTISTS_V2_KEYED, True, T2),
    "ls2": stg_albums(feeds.ALBUMS_V2_KEYED, True, T2),
}
DIM_COLUMNS = "eff_start_date, eff_end_date, is_current, created_at, updated_at"
ALBUM_COLUMNS = f"album_sk, album_id, {', '.join(DIM_ALBUMS.attributes)}, {DIM_COLUMNS}"
ARTIST_COLUMNS = f"artist_sk, artist_id, {', '.join(DIM_ARTISTS.attributes)}, {DIM_COLUMNS}"


def merged(old, new, key, delete=False):
    keep = "false" if delete else "true"
    return f"""with o as ({old}), n as ({new})
      select * from n union all
      select o.* from o where o.{key} is null
        or ({keep} and o.{key} not in (select {key} from n where {key} is not null))"""


def fact_cycle(new_songs):
    compare = _differs("f", "n", FACT_SONGS.compare)
    updated = ", ".join(
        f"case when {compare} then n.{c} else f.{c} end {c}" for c in FACT_SONGS.attributes
    )
    parts = {
        **FACT,
        **NEXT,
        "s2": stg_songs(new_songs, True, T2),
        "a2": f"select * from {next_dim(DIM_ARTISTS, 'a1', 'as2')} d",
        "l2": f"select * from {next_dim(DIM_ALBUMS, 'l1', 'ls2')} d",
        "n": f"select * from ({looked_up('s2', 'a2', 'l2')}) s where data_quality_flag='VALID'",
    }
    return ctes(**parts) + f"""
      select f.song_sk, f.song_id, {updated}, f._load_timestamp, f._source_file,
        case when n.song_id is not null then true
             when f.song_id not in (select song_id from s2) then false
             else f.is_valid end is_valid
      from f1 f left join n on f.song_id=n.song_id
      union all
      select (select max(song_sk) from f1) + row_number() over (order by song_id), song_id,
        {", ".join(FACT_SONGS.attributes)}, {T2}, cast(null as varchar), true
      from n where song_id not in (select song_id from f1)"""


STAR = """f1 f join a1 a on f.artist_sk=a.artist_sk and a.is_current
  join l1 l on f.album_sk=l.album_sk and l.is_current where f.is_valid"""
FORMATTED = """concat(f.duration_minutes,':',lpad(cast(f.duration_seconds as varchar),2,'0'))"""
SUMMARY = f"""select a.artist_name, count(distinct f.song_id) total_songs,
  count(distinct f.album_sk) total_albums,
  cast((2*sum(f.song_duration_ms)+1000*count(*))//(2000*count(*)) as bigint)
    avg_song_duration_sec,
  min(l.album_release_date) earliest_album, max(l.album_release_date) latest_album,
  cast(sum(l.album_total_tracks) as bigint) total_tracks_across_albums
  from {STAR} group by a.artist_name"""
SECONDS = "date_diff('second', {0}, {1})"


def _landed(entity, text):
    return f"""select *, {T1} _load_timestamp, 'NEW' load_status
      from ({_clean(entity.columns, text)}) r"""


def _not_in(new):
    return ctes(
        o=stg_songs(feeds.SONGS_V1), n=stg_songs(new, True, T2)
    ) + "select song_id, song_name from o where song_id not in (select song_id from n)"


def _guarded(new):
    return ctes(
        o=stg_songs(feeds.SONGS_V1), n=stg_songs(new, True, T2)
    ) + """select song_id, song_name, data_quality_flag from o
      where not coalesce((select count(*) from n) > 0
                         and song_id not in (select song_id from n), false)"""


SNAPSHOT = ctes(
    o=stg_songs(feeds.SONGS_V1_KEYED), n=stg_songs(feeds.SONGS_V2_KEYED, True, T2)
)
NEXT_ALBUMS = f"select * from {next_dim(DIM_ALBUMS, 'l1', 'ls2')} d"
AUDIT_STEP = "select '{0}' task_name, '{1}' task_layer, '{2}' operation, '{3}' target_table,"


def _staging_counts(task, target, old, new, key):
    return f"""{AUDIT_STEP.format(task, "STAGING", "MERGE+DELETE", target)}
      (select count(*) from ({new}) n) rows_inserted, 0::bigint rows_updated,
      (select count(*) from ({old}) o where {key} not in (select {key} from ({new}) n))
        rows_deleted"""


def _dim_counts(task, target, old, new, key):
    reopened = f"""(select count(*) from {new} n where n.eff_start_date={D2}
      and n.{key} in (select {key} from {old}))"""
    return f"""{AUDIT_STEP.format(task, "WAREHOUSE", "SCD2_MERGE+INSERT", target)}
      {reopened}, (select count(*) from {new} where updated_at={T2}) - {reopened}, 0::bigint"""


def audit_log():
    compare = _differs("f", "n", FACT_SONGS.compare)
    parts = {
        **FACT,
        **NEXT,
        "a2": f"select * from {next_dim(DIM_ARTISTS, 'a1', 'as2')} d",
        "l2": NEXT_ALBUMS,
        "n": f"select * from ({looked_up('s2', 'a2', 'l2')}) s where data_quality_flag='VALID'",
    }
    staging = [
        _staging_counts(
            "TASK_LOAD_STAGING_SONGS", "STG_SONGS", "select * from s1", "select * from s2",
            "song_id",
        ),
        _staging_counts(
            "TASK_LOAD_STAGING_ARTISTS", "STG_ARTISTS", stg_artists(feeds.ARTISTS_V1_KEYED),
            "select * from as2", "artist_id",
        ),
        _staging_counts(
            "TASK_LOAD_STAGING_ALBUMS", "STG_ALBUMS", stg_albums(feeds.ALBUMS_V1_KEYED),
            "select * from ls2", "album_id",
        ),
        _dim_counts("TASK_LOAD_DIMENSIONS_ARTISTS", "DIM_ARTISTS", "a1", "a2", "artist_id"),
        _dim_counts("TASK_LOAD_DIMENSIONS_ALBUMS", "DIM_ALBUMS", "l1", "l2", "album_id"),
        f"""{AUDIT_STEP.format("TASK_LOAD_FACTS", "WAREHOUSE", "MERGE+SOFT_DELETE", "FACT_SONGS")}
          (select count(*) from n left join f1 f on f.song_id=n.song_id
             where f.song_id is null or {compare}),
          (select count(*) from f1 where not is_valid and song_id in (select song_id from n)),
          (select count(*) from f1 where is_valid
             and song_id not in (select song_id from s2))""",
    ]
    return ctes(**parts) + " union all ".join(staging)


ORACLE = {
    "land_songs": _landed(SONGS, feeds.songs()),
    "land_artists": _landed(ARTISTS, feeds.artists()),
    "land_albums": _landed(ALBUMS, feeds.ALBUMS_V1),
    "land_rejects": f"select line bad_row from ({feeds.ARTIST_LINES}) l where is_bad",
    "null_tokens": _clean(SONGS.columns, feeds.TOKENS),
    "load_history": f"""select 'RAW_SONGS' table_name, _source_file source_file,
        {T1} load_time,
        case when count(bad_row)=0 then 'LOADED' when count(bad_row)=count(*)
             then 'LOAD_FAILED' else 'PARTIALLY_LOADED' end status,
        count(*)-count(bad_row) row_count, count(bad_row) error_count,
        min_by(bad_row, _file_row_number) filter (where bad_row is not null) first_error
      from ({feeds.LOADS}) l group by _source_file""",
    "raw_counts": f"""select 'RAW_SONGS' table_name, count(*) row_count
        from ({feeds.songs()}) s
      union all select 'RAW_ARTISTS', count(*) from ({feeds.artists()}) a
      union all select 'RAW_ALBUMS', count(*) from ({feeds.ALBUMS_V1}) l""",
    "load_status_counts": f"""select case when h%4<=2 then 'LOADED' else 'NEW' end load_status,
        count(*) cnt from ({feeds.songs()}) s group by 1""",
    "latest_load": """select event_id, user_id from events
      where date_trunc('day', ts) = (select max(date_trunc('day', ts)) from events)""",
    "add_column_default": "select s_suppkey, s_name, true is_valid from supplier",
    "stream_actions": "select 'INSERT' \"action\", count(*) n from lineitem",
    "stage_songs": stg_songs(feeds.songs()),
    "stage_artists": stg_artists(feeds.artists()),
    "stage_albums": stg_albums(feeds.ALBUMS_V1),
    "stage_songs_inc": stg_songs(feeds.SONGS_V2, True, T2),
    "stage_artists_inc": stg_artists(feeds.ARTISTS_V2, True, T2),
    "stage_albums_inc": stg_albums(feeds.ALBUMS_V2, True, T2),
    "quality_flags": f"""select song_url, {_flag(*SONG_RULES)} data_quality_flag
      from ({_raw(SONGS, feeds.songs())}) r""",
    "quality_summary": f"""select 'STG_SONGS' table_name, data_quality_flag, count(*) cnt
        from ({stg_songs(feeds.songs())}) s group by 1,2
      union all select 'STG_ARTISTS', data_quality_flag, count(*)
        from ({stg_artists(feeds.artists())}) s group by 1,2
      union all select 'STG_ALBUMS', data_quality_flag, count(*)
        from ({stg_albums(feeds.ALBUMS_V1)}) s group by 1,2""",
    "filter_current": ctes(**STATE, **NEXT)
    + f"select album_sk, album_id, eff_start_date from ({NEXT_ALBUMS}) d where is_current",
    "filter_in_list": f"""select audit_id, task_name from ({feeds.AUDIT}) a
      where task_name in ('TASK_LOAD_STAGING_SONGS','TASK_LOAD_FACTS',
                          'TASK_LOAD_DIMENSIONS_ALBUMS')""",
    "recent_range": """select event_id, ts from events
      where ts >= timestamp '2024-01-30 00:00:00' - interval '1' day""",
    "run_id_format": "select event_id, strftime(ts,'%Y%m%d%H%M%S') run_id from events",
    "change_detect": ctes(
        o=stg_albums(feeds.ALBUMS_V1_KEYED), n=stg_albums(feeds.ALBUMS_V2_KEYED, True, T2)
    )
    + f"""select o.album_id, {_differs("o", "n", DIM_ALBUMS.compare)} is_changed,
      {" or ".join(f"o.{c} is distinct from n.{c}" for c in DIM_ALBUMS.compare)}
        is_changed_null_safe from o join n on o.album_id=n.album_id""",
    "semi_in": ctes(o=stg_songs(feeds.SONGS_V1), n=stg_songs(feeds.SONGS_V2, True, T2))
    + """select song_id, song_name from o
      where song_id in (select song_id from n where data_quality_flag='VALID')""",
    "anti_not_in": _not_in(feeds.SONGS_V2_KEYED),
    "anti_not_in_null_keys": _not_in(feeds.SONGS_V2),
    "anti_not_in_empty": ctes(o=stg_songs(feeds.SONGS_V1)) + "select song_id, song_name from o",
    "guarded_delete": _guarded(feeds.SONGS_V2_KEYED),
    "guarded_delete_null_keys": _guarded(feeds.SONGS_V2),
    "merge_upsert": """select t.c_custkey, case when t.c_custkey%3=0 then t.c_name
          else concat(t.c_name,' v2') end c_name, t.c_acctbal,
        case when t.c_custkey%3=0 then 'keep' else 'update' end op from customer t
      union all select -1-c_custkey, concat(c_name,' v2'), 0.0::double, 'insert'
      from customer where c_custkey%3=0""",
    "merge_dup_new_keys": """select c_custkey, case when c_custkey%2=1 then c_name
          else concat(c_name,' v2') end c_name, c_acctbal,
        case when c_custkey%2=1 then 'keep' else 'update' end op from customer
      union all select -1 - c_custkey%10, concat(c_name,' v2'), null::double, 'insert'
      from customer where c_custkey%2=1""",
    "land_lineage": f"""select count(*) n_rows, count(*) n_places, count(*) last_places,
        1::bigint first_place from ({feeds.songs()}) s""",
    "short_long_rows": f"""with l as (select is_bad, is_bad and line like '%,extra' is_long
        from ({feeds.ARTIST_LINES}) a)
      select short_rows, long_rows,
        count_if(not is_bad or (is_long and long_rows='keep')
                 or (is_bad and not is_long and short_rows='keep'))::bigint n_rows,
        count_if(not is_bad or (is_long and long_rows='keep'))::bigint n_urls,
        count_if((is_long and long_rows='reject')
                 or (is_bad and not is_long and short_rows='reject'))::bigint n_rejects
      from l, (values ('keep'),('reject')) s(short_rows), (values ('keep'),('reject')) r(long_rows)
      group by all""",
    "try_timestamp_forms": f"""select o_orderkey,
        case o_orderkey%8 when 4 then cast(concat(t,':00') as timestamp)
          when 5 then cast(t as timestamp)
          when 7 then null
          when 6 then cast(concat(substr(t,1,10),' 10:11:12.5') as timestamp)
          else cast(concat(substr(t,1,10),' 10:11:12') as timestamp) end ts
      from ({feeds.TIME_TEXTS}) x""",
    "dedupe_unknown_current": """with e as (select event_id, user_id,
        case when event_id%5>0 then event_type<>'view' end is_current from events)
      select * from e where is_current is null or not is_current or event_id in
        (select max(event_id) from e where is_current group by user_id)""",
    "dedupe_latest_rows": """with e as (select event_id, ts,
        case when event_id%7>0 then concat(' ',user_id) end k from events)
      select event_id, k from e where k is null
      union all (select event_id, k from e where k is not null
        qualify row_number() over (partition by k order by ts desc, event_id desc) = 1)""",
    "merge_songs": merged(
        stg_songs(feeds.SONGS_V1), stg_songs(feeds.SONGS_V2, True, T2), "song_id"
    ),
    "merge_artists": merged(
        stg_artists(feeds.ARTISTS_V1), stg_artists(feeds.ARTISTS_V2, True, T2), "artist_id"
    ),
    "merge_albums": merged(
        stg_albums(feeds.ALBUMS_V1), stg_albums(feeds.ALBUMS_V2, True, T2), "album_id"
    ),
    "merge_snapshot": merged(
        stg_songs(feeds.SONGS_V1_KEYED), stg_songs(feeds.SONGS_V2_KEYED, True, T2), "song_id",
        delete=True,
    ),
    "merge_null_keys": f"""select song_url, song_name, _load_timestamp
      from ({stg_songs(feeds.SONGS_V1)}) o where song_id is null
      union all select song_url, song_name, _load_timestamp
      from ({stg_songs(feeds.SONGS_V2, True, T2)}) n where song_id is null""",
    "merge_counts": SNAPSHOT
    + """select case when o.song_id is null then 'insert' when n.song_id is null then 'delete'
        else 'update' end op, count(*) n from o full join n on o.song_id=n.song_id group by 1""",
    "merge_duplicates": """select k line_key, count(*) source_rows
      from (select concat(l_orderkey,'-',l_linenumber) k from lineitem) s
      where k in (select concat(l_orderkey,'-',l_linenumber) from lineitem
                  where l_quantity>25)
      group by k having count(*)>1""",
    "merge_fact": ctes(
        **FACT,
        **NEXT,
        n=f"select * from ({looked_up('s2')}) s where data_quality_flag='VALID'",
    )
    + f"""select coalesce(f.song_id, n.song_id) song_id,
      {", ".join(
          f"case when f.song_id is null or {_differs('f', 'n', FACT_SONGS.compare)} "
          f"then n.{c} else f.{c} end {c}" for c in FACT_SONGS.attributes)},
      case when f.song_id is null then {T2} else f._load_timestamp end _load_timestamp,
      f._source_file, coalesce(f.is_valid, true) is_valid,
      case when f.song_id is null then 'insert'
           when {_differs("f", "n", FACT_SONGS.compare)} then 'update' else 'keep' end op
      from f1 f full join n on f.song_id=n.song_id""",
    "surrogate_keys": f"""select song_id, song_name,
        1000 + row_number() over (order by song_id) song_sk
      from ({stg_songs(feeds.SONGS_V1)}) s where data_quality_flag='VALID'""",
    "dedupe_latest": """select event_id, user_id, event_type from events
      where event_id in (select max(event_id) from events group by user_id)""",
    "dedupe_latest_dim": """select event_id, user_id, event_type<>'view' is_current from events
      where event_type='view' or event_id in
        (select max(event_id) from events where event_type<>'view' group by user_id)""",
    "backfill_dates": ctes(**STATE, **NEXT)
    + f"""select album_sk, album_id,
        case when is_current then {D2} else eff_start_date end eff_start_date,
        case when not is_current then eff_end_date - 1 else eff_end_date end eff_end_date,
        is_current from ({NEXT_ALBUMS}) d""",
    "scd2_initial_artists": first_dim(DIM_ARTISTS, stg_artists(feeds.ARTISTS_V1)),
    "scd2_initial_albums": first_dim(DIM_ALBUMS, stg_albums(feeds.ALBUMS_V1)),
    "scd2_initial_again": ctes(**STATE, **NEXT)
    + f"""select {ALBUM_COLUMNS} from {next_dim(
        DIM_ALBUMS, "l1", "ls2", DIM_ALBUMS.initial_compare, missing=False, reopen=False)} d""",
    "scd2_artists": ctes(**STATE, **NEXT)
    + f"select {ARTIST_COLUMNS} from {next_dim(DIM_ARTISTS, 'a1', 'as2')} d",
    "scd2_albums": ctes(**STATE, **NEXT) + f"select {ALBUM_COLUMNS} from ({NEXT_ALBUMS}) d",
    "scd2_albums_null_keys": ctes(
        l1=first_dim(DIM_ALBUMS, stg_albums(feeds.ALBUMS_V1)),
        ls2=stg_albums(feeds.ALBUMS_V2, True, T2),
    )
    + f"select {ALBUM_COLUMNS} from ({NEXT_ALBUMS}) d",
    "scd2_actions": ctes(**STATE, **NEXT)
    + f"""select album_id, {", ".join(DIM_ALBUMS.attributes)}, 'UPSERT' "action"
        from ls2 where data_quality_flag='VALID'
      union all select album_id, null, null, null, null, null, 'DELETE' from l1
        where album_id not in (select album_id from ls2)""",
    "dim_as_of": f"""select o_orderkey, o_custkey c_custkey, cast(o_orderdate as date) o_date,
        version_name, eff_start_date, eff_end_date
      from orders join ({feeds.CUSTOMER_VERSIONS}) v on o_custkey=c_custkey
        and eff_start_date <= cast(o_orderdate as date)
        and (eff_end_date is null or cast(o_orderdate as date) <= eff_end_date)""",
    "sk_lookup": ctes(**{**STATE, "s1": stg_songs(feeds.SONGS_V1)})
    + f"""select song_url, artist_id, artist_sk, album_id, album_sk
      from ({looked_up("s1")}) s""",
    "fact_initial": ctes(
        **FACT,
        sn=stg_songs(feeds.SONGS_V2_KEYED, False, T2),
        n=f"select * from ({looked_up('sn')}) s where data_quality_flag='VALID'",
    )
    + f"""select f.song_sk, f.song_id,
        {", ".join(
            "case when coalesce(f.song_name<>n.song_name,false) then n.song_name "
            "else f.song_name end song_name" if c == "song_name" else f"f.{c}"
            for c in FACT_SONGS.attributes)},
        case when coalesce(f.song_name<>n.song_name,false) then {T2}
             else f._load_timestamp end _load_timestamp, f._source_file, f.is_valid
      from f1 f left join n on f.song_id=n.song_id
      union all
      select (select max(song_sk) from f1) + row_number() over (order by song_id), song_id,
        {", ".join(FACT_SONGS.attributes)}, {T2}, '2024-02-02 00:00:00.000', true
      from n where song_id not in (select song_id from f1)""",
    "fact_cycle": fact_cycle(feeds.SONGS_V2_KEYED),
    "fact_cycle_null_keys": fact_cycle(feeds.SONGS_V2),
    "soft_delete": ctes(**FACT, **NEXT)
    + """select song_sk, song_id, is_valid and song_id in (select song_id from s2) is_valid
      from f1""",
    "revalidate": ctes(**FACT, **NEXT)
    + """select song_sk, song_id, is_valid or song_id in
        (select song_id from s2 where data_quality_flag='VALID') is_valid from f1""",
    "songs_enriched": ctes(**FACT)
    + f"""select f.song_id, f.song_name, {FORMATTED} song_duration_formatted,
        f.song_duration_ms, f.song_added_date, f.song_url, a.artist_name,
        a.external_url artist_url, l.album_name, l.album_release_date, l.album_total_tracks,
        l.release_year, l.album_url from {STAR}""",
    "artist_summary": ctes(**FACT) + SUMMARY,
    "songs_per_artist": ctes(**FACT)
    + f"select artist_name, total_songs, total_albums from ({SUMMARY}) s",
    "longest_songs": ctes(**FACT)
    + f"""select song_name, artist_name, song_duration_formatted from
      (select f.song_name, a.artist_name, {FORMATTED} song_duration_formatted from {STAR}
       order by f.song_duration_ms desc nulls first, f.song_id limit 10) t""",
    "albums_per_year": ctes(**STATE)
    + """select release_year, count(*) albums_released from l1 where is_current
      group by release_year""",
    "songs_per_month": ctes(**FACT)
    + """select cast(date_trunc('month', song_added_date) as date) "month",
        count(*) songs_added from f1 group by 1""",
    "audit_summary": f"""select pipeline_run_id, min(start_time) pipeline_start,
        max(end_time) pipeline_end,
        {SECONDS.format("min(start_time)", "max(end_time)")} total_duration_sec,
        count(*) total_operations, cast(sum(rows_inserted) as bigint) total_inserted,
        cast(sum(rows_updated) as bigint) total_updated,
        cast(sum(rows_deleted) as bigint) total_deleted,
        case when sum(case when status='FAILED' then 1 else 0 end)>0 then 'FAILED'
             when sum(case when status='SKIPPED' then 1 else 0 end)=count(*) then 'SKIPPED'
             else 'SUCCESS' end overall_status
      from ({feeds.AUDIT}) a group by pipeline_run_id""",
    "audit_recent": f"""select task_name, status, start_time, end_time,
        {SECONDS.format("start_time", "end_time")} duration_sec, error_message
      from ({feeds.AUDIT}) a
      where start_time >= timestamp '2024-01-29 00:00:00' and task_name in
        ('TASK_LOAD_STAGING_SONGS','TASK_LOAD_FACTS','TASK_LOAD_DIMENSIONS_ALBUMS')
      order by start_time desc, task_name, audit_id limit 50""",
    "audit_log": audit_log(),
    "layer_counts": ctes(**FACT)
    + f"""select 'DIM_ALBUMS' tbl, count(*) current_count from l1 where is_current
      union all select 'DIM_ARTISTS', count(*) from a1 where is_current
      union all select 'FACT_SONGS', count(*) from f1
      union all select 'STG_ALBUMS', count(*) from ({stg_albums(feeds.ALBUMS_V1_KEYED)}) s
      union all select 'STG_ARTISTS', count(*) from ({stg_artists(feeds.ARTISTS_V1_KEYED)}) s
      union all select 'STG_SONGS', count(*) from s1""",
    "check_duplicates": """select concat(l_orderkey,'-',l_linenumber) line_key,
        count(*) row_count from lineitem group by 1 having count(*)>1""",
    "check_orphans": ctes(**FACT)
    + """select song_id, artist_sk from f1 where artist_sk is not null
      and artist_sk not in (select artist_sk from a1 where artist_sk%10<>0)""",
    "check_text_limits": " union all ".join(
        f"""select '{c}' column_name, {n}::bigint max_length,
          count(*) filter (where length({c})>{n}) rows_over
        from ({_raw(SONGS, feeds.songs())}) r"""
        for c, n in feeds.TIGHT_LIMITS.items()
    ),
    "check_scd2_overlap": f"""select * from (
        select c_custkey, version_sk, eff_start_date, eff_end_date,
          lead(eff_start_date) over (partition by c_custkey
            order by eff_start_date, version_sk) next_start_date
        from (select c_custkey, version_sk, eff_start_date,
                case when c_custkey%9=0 then cast(eff_end_date + interval '40' day as date)
                     else eff_end_date end eff_end_date
              from ({feeds.CUSTOMER_VERSIONS}) v) v
        where eff_end_date is null or eff_start_date<=eff_end_date) w
      where next_start_date is not null
        and (eff_end_date is null or eff_end_date>=next_start_date)""",
}
