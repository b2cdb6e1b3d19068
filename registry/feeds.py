"""Text feeds derived from the given tables, dirt included.

Every text runs unchanged on Spark SQL and on the checking engine.
"""

from __future__ import annotations

from datetime import date, datetime

RUN_TS = datetime(2024, 2, 1)
RUN_DATE = date(2024, 2, 1)
NEXT_TS = datetime(2024, 2, 2)
NEXT_DATE = date(2024, 2, 2)


# Two snapshots of each feed, both made of the whole table.  The second renames some
# entries, lacks some keys of the first and has new ones in their place.


def songs(version: int = 1, null_keys: bool = True) -> str:
    no_key = "when h=13 then null " if null_keys else ""
    name, key = "", "k"
    if version == 2:
        name, key = "when h=47 then 'renamed' ", "case when h in (7,53) then concat(k,'-n') else k end"
    return f"""
  select case {no_key}when h%10=0 then concat('  ',{key},' ') else {key} end song_id,
         case when h=19 then null {name}else concat(' Song ',l_partkey) end song_name,
         case when h=17 then 'N/A' when h=23 then 'abc' when h=29 then '1000.5'
              when h=43 then '119700'
              else cast(cast(floor(px*5) as bigint) as varchar(20)) end song_duration,
         concat('http://x/',k) song_url,
         case when h=31 then 'bad-date'
              else concat(substr(cast(d as varchar(30)),1,10),' 10:11:12') end song_added,
         case when h=37 then null else concat('AL',l_partkey) end album_id,
         case when h=41 then null else concat('AR',l_suppkey) end artist_id,
         h
  from (select concat(l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey) k,
               l_partkey, l_suppkey,
               (l_orderkey*31+l_partkey*7+l_linenumber)%100 h,
               max(l_extendedprice) px, max(l_shipdate) d
        from lineitem group by l_orderkey,l_linenumber,l_partkey,l_suppkey) b"""


SONGS_V1, SONGS_V2 = songs(1), songs(2)
SONGS_V1_KEYED, SONGS_V2_KEYED = songs(1, False), songs(2, False)


def artists(version: int = 1, null_keys: bool = True) -> str:
    no_key = "when s_suppkey%20=3 then null " if null_keys else ""
    name, new = "s_name", "false"
    if version == 2:
        name = "case when s_suppkey%7=0 then concat(s_name,' v2') else s_name end"
        new = "s_suppkey%11=0"
    return f"""
  select case {no_key}when {new} then concat('AR',s_suppkey,'-n')
              else concat('AR',s_suppkey) end artist_id,
         case when s_suppkey%20=4 then null else {name} end artist_name,
         concat('http://ar/',s_suppkey,' ') external_url
  from supplier"""


ARTISTS_V1, ARTISTS_V2 = artists(1), artists(2)
ARTISTS_V1_KEYED, ARTISTS_V2_KEYED = artists(1, False), artists(2, False)


def albums(version: int = 1, null_keys: bool = True) -> str:
    no_key = "when p_partkey%50=3 then null " if null_keys else ""
    name, bad, na, new = "concat(' ',p_name,' ')", 6, 7, "false"
    if version == 2:
        name = "case when p_partkey%7=0 then concat(p_name,' v2') else p_name end"
        bad, na, new = 9, 8, "p_partkey%11=0"
    return f"""
  select case {no_key}when {new} then concat('AL',p_partkey,'-n')
              else concat('AL',p_partkey) end album_id,
         {name} album_name,
         case when p_partkey%40=5 then '07/14/2026' when p_partkey%40={bad} then '2020-13-01'
              else concat(cast(1980+p_partkey%45 as varchar(4)),'-',
                          lpad(cast(1+p_partkey%12 as varchar(2)),2,'0'),'-',
                          lpad(cast(1+p_partkey%28 as varchar(2)),2,'0')) end album_release_date,
         case when p_partkey%60={na} then 'N/A' else cast(p_size as varchar(10)) end
           album_total_tracks,
         concat('http://al/',p_partkey) album_url
  from part"""


ALBUMS_V1, ALBUMS_V2 = albums(1), albums(2)
ALBUMS_V1_KEYED, ALBUMS_V2_KEYED = albums(1, False), albums(2, False)

# An audit log out of the event table: a run per day, a step per event.
AUDIT = """
  select event_id audit_id,
         concat('run-',substr(cast(ts as varchar(30)),1,10),'-',user_id%100) pipeline_run_id,
         case event_type when 'click' then 'TASK_LOAD_STAGING_SONGS'
              when 'view' then 'TASK_LOAD_FACTS' when 'error' then 'TASK_LOAD_DIMENSIONS_ALBUMS'
              else 'TASK_OTHER' end task_name,
         case when event_type='error' then 'FAILED' when event_type='view' then 'SKIPPED'
              else 'SUCCESS' end status,
         case when event_type='error' then concat('failed at ',event_id) end error_message,
         cast(floor(value) as bigint) rows_inserted,
         event_id%3 rows_updated, event_id%5 rows_deleted,
         ts start_time,
         ts + interval '1' second * (event_id%90) end_time
  from events"""

# Lines of an artist file: some with a field too many, some with one too few.
ARTIST_LINES = """
  select case when h%11=0 then concat('AR',h,',Name ',h) when h%13=0
                   then concat('AR',h,',Name ',h,',http://x/',h,',extra')
              else concat('AR',h,',Name ',h,',http://x/',h) end line,
         h%11=0 or h%13=0 is_bad
  from (select l_orderkey*10+l_linenumber h from lineitem) b"""

# The song feed with all the texts for "no value".
TOKENS = """
  select case h%7 when 0 then 'NULL' when 1 then 'null' when 2 then 'N/A' when 3 then ''
              when 4 then 'n/a' else song_id end song_id,
         case when h%9=0 then '' else song_name end song_name,
         song_duration, song_url,
         case when h%8=0 then 'null' else song_added end song_added, album_id, artist_id
  from (""" + songs() + """) s"""

# Rows of several files, some rejected; one file has only bad rows, some have none.
LOADS = """
  select concat('songs-',l_suppkey%7,'.csv') _source_file,
         l_orderkey*1000+l_linenumber*100+l_partkey%100 _file_row_number,
         case when l_suppkey%7=3 or (l_suppkey%7<5 and l_orderkey%10=1)
              then concat('bad ',l_orderkey*1000+l_linenumber*100+l_partkey%100) end bad_row
  from lineitem"""

# Three versions per customer; every 50th was changed twice in one day, which leaves
# an empty range.
_CUSTOMER = """
  (select c_custkey, c_name,
          cast(date '1996-01-01' + interval '1' day * (c_custkey%300) as date) d2,
          cast(date '1996-01-01' + interval '1' day * (c_custkey%300)
               + interval '1' day * (case when c_custkey%50=0 then 0 else 700 end)
               as date) d3
   from customer) c"""
CUSTOMER_VERSIONS = f"""
  select c_custkey, c_custkey*10+1 version_sk, concat(c_name,' v1') version_name,
         date '1990-01-01' eff_start_date,
         cast(d2 - interval '1' day as date) eff_end_date from {_CUSTOMER}
  union all
  select c_custkey, c_custkey*10+2, concat(c_name,' v2'), d2,
         cast(d3 - interval '1' day as date) from {_CUSTOMER}
  union all
  select c_custkey, c_custkey*10+3, concat(c_name,' v3'), d3, cast(null as date)
  from {_CUSTOMER}"""

TIGHT_LIMITS = {"song_id": 12, "song_name": 8, "song_duration": 5, "song_url": 1000}

# Order dates written in the forms a time may take, and one it may not.
TIME_TEXTS = """
  select o_orderkey,
         case o_orderkey%8 when 0 then concat(d,' 10:11:12') when 1 then concat(d,'T10:11:12')
              when 2 then concat(d,'T10:11:12+02:00') when 3 then concat(d,' 10:11:12Z')
              when 4 then concat(d,' 10:11') when 5 then d
              when 6 then concat(d,' 10:11:12.5 +0200') else concat('x',d) end t
  from (select o_orderkey, substr(cast(o_orderdate as varchar(30)),1,10) d from orders) b"""
