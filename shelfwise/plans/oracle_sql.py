"""DuckDB oracle text: the fixture views as CTEs, plus derived views shared by many oracles."""

from __future__ import annotations

FIXTURE_CTES = """
fx_ratings as (
  select o_custkey + 1 as user_id, l_partkey + 1 as book_id,
         cast(floor((l_quantity - 1) / 10) as int) + 1 as rating
  from lineitem join orders on o_orderkey = l_orderkey),
fx_books as (select p_partkey + 1 as id, (p_partkey + 1) * 7 + 3 as book_id, p_name as title from part),
fx_part_tag as (
  select p_partkey + 1 as id, split_part(p_name, ' ', 1) as tag_name from part
  union all select p_partkey + 1, split_part(p_name, ' ', 2) from part
  union all select p_partkey + 1, p_brand from part
  union all select p_partkey + 1, p_type from part
  union all select p_partkey + 1, concat('size-', cast(p_size as varchar(10))) from part),
fx_tags as (
  select cast(row_number() over (order by tag_name) as bigint) as tag_id, tag_name
  from (select distinct tag_name from fx_part_tag) t),
fx_book_tags as (
  select cast(case when p.id % 50 = 0 then -p.id else p.id * 7 + 3 end as varchar(20)) as goodreads_book_id,
         cast(t.tag_id as varchar(20)) as tag_id, (p.id * 31 + t.tag_id * 17) % 97 + 1 as cnt
  from fx_part_tag p join fx_tags t on t.tag_name = p.tag_name),
fx_to_read as (
  select distinct e.user_id + 1 as user_id, (e.event_id * 13 + e.user_id * 7) % n.n_parts + 1 as book_id
  from events e cross join (select count(*) as n_parts from part) n where e.event_type in ('view', 'click')),
fx_bt as (
  select b.id as book_id, cast(t.tag_id as bigint) as tag_id, t.cnt
  from fx_book_tags t join fx_books b on cast(t.goodreads_book_id as bigint) = b.book_id),
fx_freq as (select tag_id, cast(sum(cnt) as bigint) as "count", count(*) as n_books from fx_bt group by tag_id),
fx_top as (
  select f.tag_id, t.tag_name, f."count", f.n_books
  from (select * from fx_freq order by "count" desc, tag_id limit 60) f join fx_tags t on t.tag_id = f.tag_id),
fx_kept as (select * from fx_top where not regexp_matches(tag_name, 'Brand#1|PROMO')),
fx_long as (select bt.book_id, bt.tag_id, k.tag_name from fx_bt bt join fx_kept k on k.tag_id = bt.tag_id),
fx_set as (select distinct book_id, tag_id from fx_long),
fx_clean as (select user_id, book_id, max(rating) as rating from fx_ratings group by user_id, book_id),
fx_flag as (select user_id, book_id, rating, cast(rating = 5 as integer) as good from fx_clean),
fx_good as (select user_id, book_id from fx_flag where good = 1),
fx_user as (
  select min(user_id) as user_id from (select user_id from fx_ratings group by user_id having count(*) > 50) u),
fx_mine as (select f.* from fx_flag f join fx_user u on f.user_id = u.user_id)
"""


def with_fixtures(body: str, extra_ctes: str = "") -> str:
    """Prefix an oracle body with the fixture CTEs (and optional extra CTEs, comma-led)."""
    body = body.strip()
    if body[:5].lower() == "with ":
        # merge the body's own CTE list behind the fixtures
        body = body[5:]
        extra_ctes = f"{extra_ctes.strip()},\n" if extra_ctes.strip() else ""
        return f"with {FIXTURE_CTES.strip()},\n{extra_ctes}{body}"
    extra = f",\n{extra_ctes.strip()}" if extra_ctes.strip() else ""
    return f"with {FIXTURE_CTES.strip()}{extra}\n{body}"
