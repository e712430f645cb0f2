"""Query catalog: one Spark query per operator of the inventory, with its DuckDB oracle.

Each query takes (spark, sf_dir) and returns a lazy DataFrame over the whole fixture tables.
Column names and types match the oracle text so results hash-compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import aggregates as agg
from shelfwise.operators import clean, collab, joins, topk
from shelfwise.plans import features as feat
from shelfwise.plans.oracle_sql import with_fixtures
from shelfwise.session import delete_path, materialize, scratch_path, written
from shelfwise.sources.fixtures import Tables, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def q(name: str, sql: str | None = None, ctes: str = ""):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_fixtures(sql, ctes)
        return fn

    return deco


# ---------------------------------------------------------------- shared building blocks
def clean_ratings(t: Tables) -> DataFrame:
    return clean.dedup_keep_max(t.dealt(t.ratings(), "user_id", "book_id"))


def flagged(t: Tables) -> DataFrame:
    return clean.flag_good(clean_ratings(t))


def written_flags(t: Tables) -> DataFrame:
    """``flagged``, written once per query for plans that read it several times."""
    return t.memo("flagged", lambda: materialize(flagged(t)))


def norm_tags(t: Tables) -> DataFrame:
    return feat.book_tags_norm(t.book_tags(), t.books())


def kept(t: Tables) -> DataFrame:
    return feat.kept_tags(norm_tags(t), t.tags())


def long_tags(t: Tables) -> DataFrame:
    return feat.book_tag_long(norm_tags(t), kept(t))


def chosen_user(t: Tables) -> Column:
    """Smallest user id with more than 50 (raw) ratings, found once per query."""
    def build():
        heavy = t.ratings_per_user().where(F.col("n") > 50)
        return heavy.agg(F.min("user_id")).first()[0]

    return F.lit(t.memo("chosen_user", build)).cast("long")


def peer_user(t: Tables) -> Column:
    """The user sharing most good books with the chosen one (ties: lowest id), found once per query."""
    def build():
        best = topk.top_n(collab.user_similarity(written_flags(t), chosen_user(t)), [F.desc("n_common"), F.asc("other_user")], 1)
        row = best.first()
        return row["other_user"] if row else None

    return F.lit(t.memo("peer_user", build)).cast("long")


def chosen_flags(t: Tables) -> DataFrame:
    """The chosen user's rows of ``flagged``, written once per query."""
    return t.memo("chosen_flags", lambda: materialize(clean.flag_good(clean.dedup_keep_max(t.ratings_of(chosen_user(t))))))


def _compared(t: Tables) -> DataFrame:
    return collab.user_compare(written_flags(t), chosen_user(t), peer_user(t))


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- 2.1 sources
@q("fetch_limit", "select id, book_id, title from fx_books order by id limit 5")
def fetch_limit(spark, sf):
    return topk.top_n(tables(spark, sf).books(), [F.asc("id")], 5)


@q("preview", "select user_id, book_id, rating from fx_ratings order by user_id, book_id, rating limit 5")
def preview(spark, sf):
    return topk.top_n(tables(spark, sf).ratings(), [F.asc("user_id"), F.asc("book_id"), F.asc("rating")], 5)


@q("table_shape", "select count(*) as n_rows, 3 as n_cols from fx_ratings")
def table_shape(spark, sf):
    r = tables(spark, sf).ratings()
    return r.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(r.columns)))


# ---------------------------------------------------------------- 2.2 projections, casts, filters
@q("cast_ids", "select cast(goodreads_book_id as bigint) as goodreads_book_id, cast(tag_id as bigint) as tag_id, cnt from fx_book_tags")
def cast_ids(spark, sf):
    return clean.cast_ids(tables(spark, sf).book_tags(), ["goodreads_book_id", "tag_id"])


@q("cast_all_int", """select cast(user_id as integer) as user_id, cast(book_id as integer) as book_id,
       cast(rating as integer) as rating, cast(rating = 5 as integer) as good from fx_clean""")
def cast_all_int(spark, sf):
    c = clean_ratings(tables(spark, sf)).withColumn("good", F.col("rating") == 5)
    return clean.cast_all_int(c)


@q("select_columns", "select book_id, rating from fx_ratings")
def select_columns(spark, sf):
    return tables(spark, sf).ratings().select("book_id", "rating")


@q("select_positional", "select book_id, title from fx_books")
def select_positional(spark, sf):
    return clean.select_positional(tables(spark, sf).books(), -2, None)


@q("drop_columns", "select book_id, tag_id from fx_bt")
def drop_columns(spark, sf):
    return norm_tags(tables(spark, sf)).drop("cnt")


@q("rename_columns", "select id as book_id, book_id as goodreads_book_id, title from fx_books")
def rename_columns(spark, sf):
    b = tables(spark, sf).books()
    return b.withColumnsRenamed({"book_id": "goodreads_book_id"}).withColumnsRenamed({"id": "book_id"})


@q("with_constant", "select book_id, tag_id, 1 as help from fx_long")
def with_constant(spark, sf):
    return clean.with_constant(long_tags(tables(spark, sf)).select("book_id", "tag_id"), "help", 1)


@q("flag_good", "select user_id, book_id, rating, good from fx_flag")
def flag_good(spark, sf):
    return flagged(tables(spark, sf))


@q("filter_compare", 'select tag_id, tag_name, "count", n_books from fx_top where n_books < 200')
def filter_compare(spark, sf):
    t = tables(spark, sf)
    return feat.top_tags(norm_tags(t), t.tags(), feat.FIXTURE_TOP_TAGS).where(F.col("n_books") < 200)


@q("filter_param", """select l.book_id, l.tag_id, l.tag_name from fx_long l
where l.book_id = (select min(book_id) from (select book_id, count(distinct tag_id) n from fx_long group by book_id) x
                   where n = (select max(n) from (select count(distinct tag_id) n from fx_long group by book_id) y))""")
def filter_param(spark, sf):
    lt = long_tags(tables(spark, sf))
    per_book = agg.tags_per_book(lt)
    first_best = agg.argmax_rows(per_book, "n_tags").agg(F.min("book_id")).scalar()
    return clean.filter_param(lt, "book_id", first_best)


@q("lookup_by_keys", "select id, title from fx_books where id in (1411, 1428)")
def lookup_by_keys(spark, sf):
    return clean.lookup_by_keys(tables(spark, sf).books(), "id", [1411, 1428]).select("id", "title")


@q("exclude_regex", 'select tag_id, tag_name, "count", n_books from fx_kept')
def exclude_regex(spark, sf):
    return kept(tables(spark, sf))


@q("where_null", """select c.book_id, c.rating as rating_y from fx_clean c
where c.user_id = (select other_user from (select g2.user_id as other_user, count(*) n from fx_good g1 join fx_good g2
        on g1.book_id = g2.book_id and g2.user_id <> g1.user_id where g1.user_id = (select user_id from fx_user)
        group by g2.user_id order by n desc, other_user limit 1) p)
  and c.book_id not in (select book_id from fx_mine)""")
def where_null(spark, sf):
    return _compared(tables(spark, sf)).where(F.col("rating_x").isNull()).select("book_id", "rating_y")


@q("drop_null", """select m.book_id, m.rating as rating_x, c.rating as rating_y from fx_mine m join fx_clean c on c.book_id = m.book_id
where c.user_id = (select other_user from (select g2.user_id as other_user, count(*) n from fx_good g1 join fx_good g2
        on g1.book_id = g2.book_id and g2.user_id <> g1.user_id where g1.user_id = (select user_id from fx_user)
        group by g2.user_id order by n desc, other_user limit 1) p)""")
def drop_null(spark, sf):
    return _compared(tables(spark, sf)).dropna()


@q("scale_by_scalar", """select rating, count(*) as n, round(count(*) / (select count(*) from fx_clean), 6) as share
from fx_clean group by rating""")
def scale_by_scalar(spark, sf):
    c = clean_ratings(tables(spark, sf))
    total = c.agg(F.count(F.lit(1))).scalar()
    return clean.scale_by_count(agg.rating_distribution(c), "n", total, "share").withColumn("share", r6("share"))


@q("dense_id_check", """select count(distinct book_id) as n_distinct, min(book_id) as min_id, max(book_id) as max_id,
       (min(book_id) = 1 and max(book_id) = count(distinct book_id)) as is_dense from fx_ratings""")
def dense_id_check(spark, sf):
    return clean.dense_id_check(tables(spark, sf).ratings(), "book_id")


@q("id_spine", """select s.user_id, coalesce(c.n, 0) as n_ratings
from (select unnest(range(1, m + 1)) as user_id from (select max(user_id) as m from fx_clean)) s
left join (select user_id, count(*) as n from fx_clean group by user_id) c on c.user_id = s.user_id""")
def id_spine(spark, sf):
    c = clean_ratings(tables(spark, sf))
    spine = clean.id_spine(c, "user_id")
    counts = c.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "user_id", "left").select("user_id", F.coalesce("n", F.lit(0)).alias("n_ratings"))


@q("relevel_ids", """select user_id, cast(row_number() over (order by user_id) - 1 as bigint) as user_idx
from (select distinct user_id from fx_ratings) u""")
def relevel_ids(spark, sf):
    return clean.relevel_ids(tables(spark, sf).ratings(), "user_id", "user_idx", start=0)


# ---------------------------------------------------------------- 2.3 joins
@q("normalize_ids", "select book_id, tag_id, cnt from fx_bt")
def normalize_ids(spark, sf):
    return norm_tags(tables(spark, sf))


@q("join_inner_shared", "select book_id, tag_id, tag_name from fx_long")
def join_inner_shared(spark, sf):
    return long_tags(tables(spark, sf))


@q("join_inner_multikey", """select r.user_id, r.book_id, r.rating, c.rating as max_rating
from fx_ratings r join fx_clean c on c.user_id = r.user_id and c.book_id = r.book_id""")
def join_inner_multikey(spark, sf):
    t = tables(spark, sf)
    c = clean_ratings(t).withColumnRenamed("rating", "max_rating")
    return t.ratings().join(c, ["user_id", "book_id"])


@q("join_fact_features", """select f.user_id, f.book_id, f.rating, s.tag_id from fx_clean f join fx_set s on s.book_id = f.book_id""")
def join_fact_features(spark, sf):
    t = tables(spark, sf)
    return clean_ratings(t).join(feat.book_tag_set(long_tags(t)), "book_id")


@q("join_left_features", """select m.book_id, m.good, s.tag_id from fx_mine m left join fx_set s on s.book_id = m.book_id""")
def join_left_features(spark, sf):
    t = tables(spark, sf)
    mine = flagged(t).where(F.col("user_id") == chosen_user(t)).select("book_id", "good")
    return mine.join(feat.book_tag_set(long_tags(t)), "book_id", "left")


@q("join_full_outer", """select coalesce(a.tag_name, p.tag_name) as tag_name, a.share as share_act, p.share as share_pred
from (select tag_name, round(count(tag_id) / (select count(*) from fx_mine where good = 1), 6) as share
      from fx_long where book_id in (select book_id from fx_mine where good = 1)
      group by tag_name order by count(tag_id) desc, tag_name limit 10) a
full join (select tag_name, round(count(tag_id) / (select count(*) from fx_mine where good = 0), 6) as share
      from fx_long where book_id in (select book_id from fx_mine where good = 0)
      group by tag_name order by count(tag_id) desc, tag_name limit 10) p on a.tag_name = p.tag_name""")
def join_full_outer(spark, sf):
    t = tables(spark, sf)
    lt = long_tags(t)
    mine = flagged(t).where(F.col("user_id") == chosen_user(t))
    sides = []
    for flag, suffix in ((1, "act"), (0, "pred")):
        books = mine.where(F.col("good") == flag).select("book_id")
        share = agg.tag_share(books, lt, books.agg(F.count(F.lit(1))).scalar(), 10)
        sides.append(share.select("tag_name", r6("share").alias(f"share_{suffix}")))
    return sides[0].join(sides[1], "tag_name", "full")


@q("join_ratings_outer", """select coalesce(a.book_id, b.book_id) as book_id, a.rating as rating_x, b.rating as rating_y
from (select book_id, rating from fx_mine) a full join (select book_id, rating from fx_clean where user_id =
  (select other_user from (select g2.user_id as other_user, count(*) n from fx_good g1 join fx_good g2
        on g1.book_id = g2.book_id and g2.user_id <> g1.user_id where g1.user_id = (select user_id from fx_user)
        group by g2.user_id order by n desc, other_user limit 1) p)) b on a.book_id = b.book_id""")
def join_ratings_outer(spark, sf):
    return _compared(tables(spark, sf))


@q("semi_join", "select id, title from fx_books where id in (select book_id from fx_mine)")
def semi_join(spark, sf):
    t = tables(spark, sf)
    mine = flagged(t).where(F.col("user_id") == chosen_user(t)).select(F.col("book_id").alias("id"))
    return joins.semi_join(t.books(), mine, "id").select("id", "title")


@q("anti_join", """select f.user_id, f.book_id, f.good from fx_flag f where not exists (select 1 from fx_mine m where m.book_id = f.book_id)""")
def anti_join(spark, sf):
    t = tables(spark, sf)
    fl = flagged(t)
    mine = fl.where(F.col("user_id") == chosen_user(t)).select("book_id")
    return joins.anti_join(fl, mine, "book_id").select("user_id", "book_id", "good")


@q("membership_flag", """select b.id, b.book_id, b.book_id in (select cast(goodreads_book_id as bigint) from fx_book_tags) as is_member
from fx_books b""")
def membership_flag(spark, sf):
    t = tables(spark, sf)
    ext = clean.cast_ids(t.book_tags(), ["goodreads_book_id"])
    return joins.membership_flag(t.books().select("id", "book_id"), ext, "book_id", "goodreads_book_id")


@q("count_true", """select count(*) filter (where b.book_id in (select cast(goodreads_book_id as bigint) from fx_book_tags)) as n_true
from fx_books b""")
def count_true(spark, sf):
    return membership_flag(spark, sf).transform(lambda d: agg.count_true(d, F.col("is_member")))


@q("gram_join", """select a.book_id, count(*) as n_partners, cast(sum(n) as bigint) as total_overlap from (
  select a.book_id, b.book_id as other_id, count(*) as n from fx_set a join fx_set b on a.tag_id = b.tag_id and a.book_id <> b.book_id
  group by a.book_id, b.book_id) a group by a.book_id""")
def gram_join(spark, sf):
    s = feat.book_tag_set(long_tags(tables(spark, sf)))
    pairs, members = joins.gram_classes(s, "tag_id", "book_id")
    # a representative meets its own class too, where each of its books has all but itself as partners
    own = F.when(F.col("rep") == F.col("other"), 1).otherwise(0)
    rows = pairs.withColumn("others", F.col("others") - own).groupBy("rep").agg(
        F.sum("others").alias("n_partners"), F.sum(F.col("n") * F.col("others")).alias("total_overlap"))
    return members.join(rows.where(F.col("n_partners") > 0), "rep").select("book_id", "n_partners", "total_overlap")


@q("cooccurrence_join", """select a.book_id, b.book_id as other_id, count(*) as n_both
from fx_good a join fx_good b on a.user_id = b.user_id and a.book_id <> b.book_id group by a.book_id, b.book_id""")
def cooccurrence_join(spark, sf):
    g = collab.good_rows(flagged(tables(spark, sf)))
    return joins.gram_join(g, "user_id", "book_id", left="book_id", right="other_id").withColumnRenamed("n", "n_both")


# ---------------------------------------------------------------- 2.4 aggregations
@q("tag_frequency", 'select tag_id, "count", n_books from fx_freq')
def tag_frequency(spark, sf):
    return agg.tag_frequency(norm_tags(tables(spark, sf)))


@q("ratings_per_user", "select user_id, count(*) as ratings from fx_ratings group by user_id order by ratings, user_id")
def ratings_per_user(spark, sf):
    return agg.ratings_per_user(tables(spark, sf).ratings())


@q("rating_distribution", "select rating, count(*) as n from fx_clean group by rating")
def rating_distribution(spark, sf):
    return agg.rating_distribution(clean_ratings(tables(spark, sf)))


@q("duplicate_ratings", """select d.user_id, d.book_id, d.dups, r.rating from
(select user_id, book_id, count(*) as dups from fx_ratings group by user_id, book_id having count(*) > 1) d
join fx_ratings r on r.user_id = d.user_id and r.book_id = d.book_id""")
def duplicate_ratings(spark, sf):
    return agg.duplicate_ratings(tables(spark, sf).ratings())


@q("duplicate_check", """select count(*) filter (where n > 1) as n_duplicated_keys
from (select user_id, book_id, count(*) as n from fx_clean group by user_id, book_id) g""")
def duplicate_check(spark, sf):
    return agg.duplicate_check(clean_ratings(tables(spark, sf)))


@q("distinct_users", "select count(distinct user_id) as n_users from fx_ratings")
def distinct_users(spark, sf):
    return agg.distinct_count(tables(spark, sf).ratings(), "user_id", "n_users")


@q("mean_good_per_book", "select book_id, round(avg(good), 6) as mean_good from fx_flag group by book_id")
def mean_good_per_book(spark, sf):
    m = agg.mean_per_group(flagged(tables(spark, sf)), "book_id", "good", "mean_good")
    return m.withColumn("mean_good", r6("mean_good"))


_DESCRIBE_SQL = """select '{c}' as "column", count({c}) as "count", round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
  cast(min({c}) as double) as min, round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50,
  round(quantile_cont({c}, 0.75), 6) as p75, cast(max({c}) as double) as max from {t}"""


def _r6_all(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


@q("describe_column", _DESCRIBE_SQL.format(c="rating", t="fx_clean") + "\nunion all\n"
   + _DESCRIBE_SQL.format(c="ratings", t="(select user_id, count(*) as ratings from fx_ratings group by user_id) u"))
def describe_column(spark, sf):
    t = tables(spark, sf)
    a = agg.describe_column(clean_ratings(t), ["rating"])
    b = agg.describe_column(t.ratings().groupBy("user_id").agg(F.count(F.lit(1)).alias("ratings")), ["ratings"])
    return _r6_all(a.unionByName(b), ["mean", "std", "p25", "p50", "p75"])


@q("id_range", "select min(user_id) as min_id, max(user_id) as max_id from fx_ratings")
def id_range(spark, sf):
    return agg.id_range(tables(spark, sf).ratings(), "user_id")


@q("global_mean", "select round(avg(ratings), 6) as mean from (select user_id, count(*) as ratings from fx_ratings group by user_id) u")
def global_mean(spark, sf):
    per_user = tables(spark, sf).ratings().groupBy("user_id").agg(F.count(F.lit(1)).alias("ratings"))
    return agg.global_mean(per_user, "ratings").withColumn("mean", r6("mean"))


@q("tags_per_book", "select book_id, count(distinct tag_id) as n_tags from fx_long group by book_id")
def tags_per_book(spark, sf):
    return agg.tags_per_book(long_tags(tables(spark, sf)))


@q("argmax_rows", """select book_id, n_tags from (select book_id, count(distinct tag_id) as n_tags from fx_long group by book_id) x
where n_tags = (select max(n_tags) from (select count(distinct tag_id) as n_tags from fx_long group by book_id) y)""")
def argmax_rows(spark, sf):
    return agg.argmax_rows(agg.tags_per_book(long_tags(tables(spark, sf))), "n_tags")


@q("tag_share", """select tag_name, count(tag_id) as n, round(count(tag_id) / (select count(*) from fx_mine), 6) as share
from fx_long where book_id in (select book_id from fx_mine) group by tag_name order by n desc, tag_name limit 10""")
def tag_share(spark, sf):
    t = tables(spark, sf)
    mine = flagged(t).where(F.col("user_id") == chosen_user(t)).select("book_id")
    out = agg.tag_share(mine, long_tags(t), mine.agg(F.count(F.lit(1))).scalar(), 10)
    return out.withColumn("share", r6("share"))


@q("idxmax_per_row", """select book_id, other_id as best_other_id, round(max_sim, 6) as max_sim from (
  select p.book_id, p.other_id, p.n_both / d.n_good as max_sim,
         row_number() over (partition by p.book_id order by p.n_both desc, p.other_id) as rn
  from (select a.book_id, b.book_id as other_id, count(*) as n_both from fx_good a join fx_good b
        on a.user_id = b.user_id and a.book_id <> b.book_id group by 1, 2) p
  join (select book_id, count(*) as n_good from fx_good group by book_id) d on d.book_id = p.book_id) x where rn = 1""")
def idxmax_per_row(spark, sf):
    # the argmax over the integer co-count equals the argmax of sim within a row
    found = collab.closest_items(written_flags(tables(spark, sf))).rows
    return found.select("book_id", F.col("closest").alias("best_other_id"), r6(F.col("n_both") / F.col("n_good")).alias("max_sim"))


@q("label_counts", "select label, count(*) as n from embeddings group by label")
def label_counts(spark, sf):
    return agg.label_counts(tables(spark, sf).embeddings(), "label")


@q("histogram_equal_width", """with s as (select min(n_books) as lo, max(n_books) as hi from fx_kept),
b as (select least(cast(floor((n_books - s.lo) * 20.0 / (s.hi - s.lo)) as bigint) + 1, 20) as bin from fx_kept, s)
select g.bin, round(s.lo + (g.bin - 1) * (s.hi - s.lo) / 20.0, 6) as lo, round(s.lo + g.bin * (s.hi - s.lo) / 20.0, 6) as hi, count(b.bin) as n
from (select unnest(range(1, 21)) as bin) g cross join s left join b on b.bin = g.bin group by g.bin, s.lo, s.hi""")
def histogram_equal_width(spark, sf):
    out = agg.histogram_equal_width(kept(tables(spark, sf)), "n_books", 20)
    return out.withColumns({"bin": F.col("bin").cast("long"), "lo": r6("lo"), "hi": r6("hi")})


@q("pivot_tag_matrix", """select b.book_id, k.tag_id, cast(s.book_id is not null as integer) as value
from (select distinct book_id from fx_set) b cross join fx_kept k left join fx_set s on s.book_id = b.book_id and s.tag_id = k.tag_id""")
def pivot_tag_matrix(spark, sf):
    """The wide 0/1 matrix over every kept tag, folded back to (book_id, tag_id, value) with its zeros."""
    t = tables(spark, sf)
    nt = materialize(norm_tags(t))
    ids = [tid for tid, _ in feat.resolve_kept(feat.kept_tags(nt, t.tags()))]
    wide = agg.pivot_tag_matrix(nt.where(F.col("tag_id").isin(ids)), ids)
    cells = F.array(*[F.struct(F.lit(i).cast("long").alias("tag_id"), F.col(f"`{i}`").alias("value")) for i in ids])
    return wide.select("book_id", F.inline(cells))


@q("multi_hot_vectors", """with r as (select tag_id, row_number() over (order by tag_id) - 1 as pos from fx_kept)
select s.book_id, cast(count(*) as integer) as n_active, string_agg(cast(r.pos as varchar), ',' order by r.pos) as positions
from fx_set s join r on r.tag_id = s.tag_id group by s.book_id""")
def multi_hot_vectors(spark, sf):
    from pyspark.ml.functions import vector_to_array

    t = tables(spark, sf)
    k = kept(t)
    vecs = feat.multi_hot_vectors(long_tags(t), feat.vocabulary(k))
    arr = vector_to_array("features")
    pos = F.filter(F.transform(arr, lambda x, i: F.when(x > 0, i)), lambda p: p.isNotNull())
    return vecs.select("book_id", F.size(pos).alias("n_active"), F.array_join(F.transform(pos, lambda p: p.cast("string")), ",").alias("positions"))


@q("rating_matrix", "select user_id, book_id, good as value from fx_flag")
def rating_matrix(spark, sf):
    return agg.rating_matrix(flagged(tables(spark, sf)), "good")


# ---------------------------------------------------------------- 2.5 windows
@q("group_max_broadcast", """select user_id, book_id, rating, max(rating) over (partition by book_id, user_id) as max_rating from fx_ratings""")
def group_max_broadcast(spark, sf):
    return clean.group_max_broadcast(tables(spark, sf).ratings(), ["book_id", "user_id"], "rating", "max_rating")


@q("dedup_keep_max", "select user_id, book_id, rating from fx_clean")
def dedup_keep_max(spark, sf):
    return clean_ratings(tables(spark, sf))


# ---------------------------------------------------------------- 2.6 sorts, limits, top-k
@q("sort_rows", 'select tag_id, tag_name, "count", n_books from fx_kept order by "count" desc, tag_id')
def sort_rows(spark, sf):
    return topk.sort_rows(kept(tables(spark, sf)), [F.desc("count"), F.asc("tag_id")])


@q("top_tags", 'select tag_id, tag_name, "count", n_books from fx_top')
def top_tags(spark, sf):
    t = tables(spark, sf)
    return feat.top_tags(norm_tags(t), t.tags(), feat.FIXTURE_TOP_TAGS)


@q("top_unread_books", """select book_id, round(avg(good), 6) as mean_good from fx_flag
where book_id not in (select book_id from fx_mine) group by book_id order by avg(good) desc, book_id limit 1000""")
def top_unread_books(spark, sf):
    t = tables(spark, sf)
    fl = flagged(t)
    mine = fl.where(F.col("user_id") == chosen_user(t))
    return topk.top_unread_books(fl, mine, 1000).withColumn("mean_good", r6("mean_good"))


@q("slice_first_n", "select book_id, count(distinct tag_id) as n_tags from fx_long group by book_id order by book_id limit 1000")
def slice_first_n(spark, sf):
    return topk.top_n(agg.tags_per_book(long_tags(tables(spark, sf))), [F.asc("book_id")], 1000)


@q("row_neighbors", """select p.book_id, p.other_id, round(p.n_both / d.n_good, 6) as sim from
  (select a.book_id, b.book_id as other_id, count(*) as n_both from fx_good a join fx_good b
   on a.user_id = b.user_id and a.book_id <> b.book_id where a.book_id = 1428 group by 1, 2) p
  join (select book_id, count(*) as n_good from fx_good group by book_id) d on d.book_id = p.book_id
order by p.n_both desc, p.other_id limit 5""")
def row_neighbors(spark, sf):
    t = tables(spark, sf)
    one = t.books().where(F.col("id") == 1428).select(F.col("id").alias("book_id"))
    sim = collab.item_similarity(flagged(t), only=one)
    return collab.row_neighbors(sim, 1428, 5).withColumn("sim", r6("sim"))


# ---------------------------------------------------------------- 2.7 set operations
@q("distinct_rows", "select distinct user_id, book_id, rating from fx_ratings")
def distinct_rows(spark, sf):
    return tables(spark, sf).ratings().distinct()


# ---------------------------------------------------------------- IBCF (flagship)
@q("item_similarity", """select p.book_id, p.other_id, p.n_both, d.n_good, round(p.n_both / d.n_good, 6) as sim from
  (select a.book_id, b.book_id as other_id, count(*) as n_both from fx_good a join fx_good b
   on a.user_id = b.user_id and a.book_id <> b.book_id group by 1, 2) p
  join (select book_id, count(*) as n_good from fx_good group by book_id) d on d.book_id = p.book_id""")
def item_similarity(spark, sf):
    return collab.item_similarity(flagged(tables(spark, sf))).withColumn("sim", r6("sim"))


_CLOSEST_SQL = """select book_id, other_id as closest, round(n_both / n_good, 6) as sim from (
  select p.book_id, p.other_id, p.n_both, d.n_good,
         row_number() over (partition by p.book_id order by p.n_both desc, p.other_id) as rn
  from (select a.book_id, b.book_id as other_id, count(*) as n_both from fx_good a join fx_good b
        on a.user_id = b.user_id and a.book_id <> b.book_id group by 1, 2) p
  join (select book_id, count(*) as n_good from fx_good group by book_id) d on d.book_id = p.book_id) x where rn = 1"""


@q("item_closest", _CLOSEST_SQL)
def item_closest(spark, sf):
    """Best partners by falling upper bounds; the table of all pairs is not formed."""
    return _closest(collab.closest_items(written_flags(tables(spark, sf))))


def _closest(found: collab.ClosestItems) -> DataFrame:
    return found.rows.select("book_id", "closest", r6(F.col("n_both") / F.col("n_good")).alias("sim"))


@q("item_closest_cost", """select cast((select sum(n * (n - 1)) from (select count(*) as n from fx_good group by user_id) s) as bigint) as total_pairs,
  true as within_total""")
def item_closest_cost(spark, sf):
    """Pairs of rating rows that the whole self-join has, and whether the closest items were found with no more."""
    found = collab.closest_items(written_flags(tables(spark, sf)))
    return spark.createDataFrame([(found.total, found.pairs <= found.total)], "total_pairs long, within_total boolean")


@q("join_add_names", """select c.book_id, b1.title, c.closest, b2.title as closest_title, c.sim
from (""" + _CLOSEST_SQL + """) c join fx_books b1 on b1.id = c.book_id join fx_books b2 on b2.id = c.closest""")
def join_add_names(spark, sf):
    t = tables(spark, sf)
    closest = item_closest(spark, sf)
    titles = t.books().select(F.col("id").alias("book_id"), "title")
    named = closest.join(titles, "book_id")
    other = t.books().select(F.col("id").alias("closest"), F.col("title").alias("closest_title"))
    return named.join(other, "closest").select("book_id", "title", "closest", "closest_title", "sim")


@q("ibcf_recommend", """select m.book_id, c.closest, c.sim from (select book_id from fx_mine where good = 1) m
join (""" + _CLOSEST_SQL + """) c on c.book_id = m.book_id""")
def ibcf_recommend(spark, sf):
    t = tables(spark, sf)
    fl = written_flags(t)
    user = chosen_user(t)
    mine = fl.where((F.col("user_id") == user) & (F.col("good") == 1)).select("book_id")
    return collab.ibcf_recommend(fl, _closest(collab.closest_items(fl, only=mine)), user)


# ---------------------------------------------------------------- 2.15 re-aimed
@q("pair_cost_preview", """with s as (select user_id, count(*) as n_rows, count(*) * (count(*) - 1) as n_pairs from fx_good group by user_id)
select user_id, n_rows, n_pairs, round(n_pairs / (select sum(n_pairs) from s), 6) as share_of_pairs,
  cast((select sum(n_pairs) from s) as bigint) as total_pairs, (select count(*) from s) as n_groups,
  cast(greatest(1, ceil(n_rows / 1024)) as bigint) as salt_buckets
from s order by n_pairs desc, user_id limit 5""")
def pair_cost_preview(spark, sf):
    g = collab.good_rows(flagged(tables(spark, sf)))
    return joins.pair_cost_preview(g, "user_id", 5)


# ---------------------------------------------------------------- 2.1 file sources (round trips)
from shelfwise.functions import vectors as vec  # noqa: E402
from shelfwise.functions.hashing import hash_pair_u32, hash_sql  # noqa: E402
from shelfwise.operators import metrics, sampling  # noqa: E402
from shelfwise.sources import files  # noqa: E402


@q("scan_csv", "select user_id, book_id, rating from fx_ratings")
def scan_csv(spark, sf):
    """Land the ratings as header CSV in the shared folder, read back with the declared schema."""
    path = files.write_csv(tables(spark, sf).ratings(), scratch_path(spark, "ratings_csv"))
    out = materialize(files.read_csv(spark, path, files.RATINGS_SCHEMA))
    delete_path(spark, path)
    return out


@q("scan_json_records", """select cast(goodreads_book_id as bigint) as goodreads_book_id, cast(tag_id as bigint) as tag_id, cnt
from fx_book_tags""")
def scan_json_records(spark, sf):
    """Land book_tags (string ids, field ``count``) as JSON arrays, read back with string ids and cast them."""
    rows = tables(spark, sf).book_tags().withColumnRenamed("cnt", "count")
    path = files.write_json_arrays(rows, scratch_path(spark, "book_tags_json"))
    out = materialize(files.read_json_records(spark, path))
    delete_path(spark, path)
    return out


# ---------------------------------------------------------------- 2.9 sampling and splitting
@q("pick_user", "select user_id, count(*) as ratings from fx_ratings group by user_id having count(*) > 50 order by user_id limit 1")
def pick_user(spark, sf):
    per_user = tables(spark, sf).ratings().groupBy("user_id").agg(F.count(F.lit(1)).alias("ratings"))
    return sampling.pick_user(per_user, 50)


@q("pick_user_seeded", f"""select user_id, ratings from (select user_id, count(*) as ratings from fx_ratings group by user_id having count(*) > 50) u
order by {hash_sql('user_id', 5)}, user_id limit 1""")
def pick_user_seeded(spark, sf):
    per_user = tables(spark, sf).ratings().groupBy("user_id").agg(F.count(F.lit(1)).alias("ratings"))
    return sampling.pick_user(per_user, 50, seed=5)


@q("user_ratings", "select user_id, book_id, rating, good from fx_mine")
def user_ratings(spark, sf):
    t = tables(spark, sf)
    return flagged(t).where(F.col("user_id") == chosen_user(t))


@q("train_test_split", f"select book_id, good, {hash_sql('book_id', sampling.SPLIT_SEED)} < 858993459 as is_test from fx_mine")
def train_test_split(spark, sf):
    mine = user_ratings(spark, sf).select("book_id", "good")
    return sampling.hash_split(mine, "book_id", 0.2)


@q("kfold_assign", f"select user_id, book_id, cast(floor({hash_sql('book_id', sampling.FOLD_SEED)} * 5 / 4294967296) as integer) as fold from fx_clean")
def kfold_assign(spark, sf):
    return sampling.kfold_assign(clean_ratings(tables(spark, sf)).select("user_id", "book_id"), "book_id", 5)


_PAIR_HASH = hash_sql(f"{hash_sql('user_id')} + book_id")


@q("resample_classes", f"""with s as (select good, count(*) as n_class from fx_flag group by good)
select 'under' as method, f.good, count(*) as n from fx_flag f join s on s.good = f.good
where {_PAIR_HASH} < floor((select min(n_class) from s) / s.n_class * 4294967296.0) group by f.good
union all
select 'over' as method, f.good, cast(sum(cast(round((select max(n_class) from s) / s.n_class) as integer)) as bigint) as n
from fx_flag f join s on s.good = f.good group by f.good
union all
select 'hybrid' as method, f.good, cast(sum(case when s.n_class >= (select avg(n_class) from s)
    then case when {_PAIR_HASH} < floor((select avg(n_class) from s) / s.n_class * 4294967296.0) then 1 else 0 end
    else cast(round((select avg(n_class) from s) / s.n_class) as integer) end) as bigint) as n
from fx_flag f join s on s.good = f.good group by f.good""")
def resample_classes(spark, sf):
    fl = flagged(tables(spark, sf))
    under = sampling.undersample(fl, "good", hash_pair_u32("user_id", "book_id"))
    over = sampling.oversample(fl, "good")
    cu = under.groupBy("good").agg(F.count(F.lit(1)).alias("n")).select(F.lit("under").alias("method"), "good", "n")
    co = over.groupBy("good").agg(F.count(F.lit(1)).alias("n")).select(F.lit("over").alias("method"), "good", "n")
    hybrid = sampling.hybrid_sample(fl, "good", hash_pair_u32("user_id", "book_id"))
    ch = hybrid.groupBy("good").agg(F.count(F.lit(1)).alias("n")).select(F.lit("hybrid").alias("method"), "good", "n")
    return cu.unionByName(co).unionByName(ch)


@q("class_weights", """select good, count(*) as n_class, round((select count(*) from fx_flag) / (2 * count(*)), 6) as weight
from fx_flag group by good""")
def class_weights(spark, sf):
    return sampling.class_weights(flagged(tables(spark, sf)), "good").withColumn("weight", r6("weight"))


# ---------------------------------------------------------------- 2.10 metrics
_PEER_SQL = """(select other_user from (select g2.user_id as other_user, count(*) n from fx_good g1 join fx_good g2
        on g1.book_id = g2.book_id and g2.user_id <> g1.user_id where g1.user_id = (select user_id from fx_user)
        group by g2.user_id order by n desc, other_user limit 1) p)"""


@q("rmse", f"""select round(sqrt(avg(power(m.rating - c.rating, 2))), 6) as rmse
from fx_mine m join fx_clean c on c.book_id = m.book_id where c.user_id = {_PEER_SQL}""")
def rmse(spark, sf):
    both = drop_null(spark, sf)
    return metrics.rmse(both, "rating_x", "rating_y").withColumn("rmse", r6("rmse"))


@q("entropy_gini", """select round(sum(-p * log2(p)), 6) as entropy, round(1 - sum(p * p), 6) as gini
from (select count(*) / (select count(*) from fx_clean) as p from fx_clean group by rating) s""")
def entropy_gini(spark, sf):
    out = metrics.impurity(clean_ratings(tables(spark, sf)), "rating")
    return out.select(r6("entropy").alias("entropy"), r6("gini").alias("gini"))


def _emb_long(t: Tables) -> DataFrame:
    e = t.embeddings()
    return e.select("vec_id", "label", F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.col("value").cast("double"))


_EMB_LONG = """el as (select vec_id, label, unnest(generate_series(0, len(embedding) - 1)) as dim,
                 cast(unnest(embedding) as double) as value from embeddings)"""


@q("within_between_ss", """select round(sum(s2 - s * s / n), 4) as within_ss, round(sum(n * power(s / n - m, 2)), 4) as between_ss
from (select label, dim, count(*) as n, sum(value) as s, sum(value * value) as s2 from el group by label, dim) c
join (select dim, avg(value) as m from el group by dim) d on d.dim = c.dim""", ctes=_EMB_LONG)
def within_between_ss(spark, sf):
    out = metrics.within_between_ss(_emb_long(tables(spark, sf)), "label")
    return out.select(F.round("within_ss", 4).alias("within_ss"), F.round("between_ss", 4).alias("between_ss"))


# ---------------------------------------------------------------- 2.11 distances
def _next_pairs(e: DataFrame) -> DataFrame:
    """Each embedding with the one of the next larger id (an equi-join on dense ranks; no all-pairs product)."""
    ranked = materialize(e.join(clean.relevel_ids(e, "vec_id", "_r"), "vec_id"))
    a = ranked.select("vec_id", F.col("embedding").alias("a"), "_r")
    b = ranked.select(F.col("vec_id").alias("other_id"), F.col("embedding").alias("b"), (F.col("_r") - 1).alias("_r"))
    return a.join(b, "_r").drop("_r")


_PAIR_LONG = """select a.vec_id, n.other_id, {agg} as dist from el a
join (select vec_id, lead(vec_id) over (order by vec_id) as other_id from embeddings) n on n.vec_id = a.vec_id
join el b on b.vec_id = n.other_id and b.dim = a.dim group by a.vec_id, n.other_id"""


@q("manhattan", _PAIR_LONG.format(agg="round(sum(abs(a.value - b.value)), 6)"), ctes=_EMB_LONG)
def manhattan(spark, sf):
    p = _next_pairs(tables(spark, sf).embeddings())
    return p.select("vec_id", "other_id", r6(vec.manhattan("a", "b")).alias("dist"))


@q("euclidean", _PAIR_LONG.format(agg="round(sqrt(sum(power(a.value - b.value, 2))), 6)"), ctes=_EMB_LONG)
def euclidean(spark, sf):
    p = _next_pairs(tables(spark, sf).embeddings())
    return p.select("vec_id", "other_id", r6(vec.euclidean("a", "b")).alias("dist"))


@q("gower", """select a.vec_id, n.other_id,
  round(sum(coalesce(abs(a.value - b.value) / nullif(r.rng, 0), 0)) / count(*), 6) as dist from el a
join (select vec_id, lead(vec_id) over (order by vec_id) as other_id from embeddings) n on n.vec_id = a.vec_id
join el b on b.vec_id = n.other_id and b.dim = a.dim
join (select dim, max(value) - min(value) as rng from el group by dim) r on r.dim = a.dim group by a.vec_id, n.other_id""",
   ctes=_EMB_LONG)
def gower(spark, sf):
    t = tables(spark, sf)
    # one range per dimension: as many numbers as one vector has entries
    el = _emb_long(t).groupBy("dim").agg((F.max("value") - F.min("value")).alias("rng"))
    ranges = F.array(*[F.lit(r["rng"]).cast("double") for r in el.orderBy("dim").collect()])
    p = _next_pairs(t.embeddings())
    double = lambda c: F.transform(c, lambda x: x.cast("double"))
    return p.select("vec_id", "other_id", r6(vec.gower(double("a"), double("b"), ranges)).alias("dist"))


def _book_counts(t: Tables) -> DataFrame:
    """Per book (all books) the number of kept tags (0 when none)."""
    s = model_tags(t)[3]
    n = s.groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))
    return t.books().select(F.col("id").alias("book_id")).join(n, "book_id", "left").select("book_id", F.coalesce("n", F.lit(0)).alias("n"))


def _next_book_overlap(t: Tables) -> DataFrame:
    """(book_id, other_id = book_id + 1, n_a, n_b, n_ab) over the kept-tag 0/1 matrix."""
    s = model_tags(t)[3]
    n = materialize(_book_counts(t))
    pairs = n.select("book_id", F.col("n").alias("n_a")).join(
        n.select(F.col("book_id").alias("other_id"), F.col("n").alias("n_b")), F.col("other_id") == F.col("book_id") + 1
    )
    ov = s.join(s.select(F.col("book_id").alias("other_id"), "tag_id"), "tag_id").where(F.col("other_id") == F.col("book_id") + 1)
    ov = ov.groupBy("book_id", "other_id").agg(F.count(F.lit(1)).alias("n_ab"))
    return pairs.join(ov, ["book_id", "other_id"], "left").withColumn("n_ab", F.coalesce("n_ab", F.lit(0)))


_NEXT_BOOK = """nb as (select b.id as book_id, coalesce(c.n, 0) as n from fx_books b
  left join (select book_id, count(*) as n from fx_set group by book_id) c on c.book_id = b.id),
pr as (select a.book_id, b.book_id as other_id, a.n as n_a, b.n as n_b, coalesce(o.n_ab, 0) as n_ab
  from nb a join nb b on b.book_id = a.book_id + 1
  left join (select x.book_id, y.book_id as other_id, count(*) as n_ab from fx_set x join fx_set y
             on y.tag_id = x.tag_id and y.book_id = x.book_id + 1 group by 1, 2) o
  on o.book_id = a.book_id and o.other_id = b.book_id)"""


@q("euclidean_limit", """select book_id, other_id, round(sqrt(n_a + n_b - 2 * n_ab), 6) as dist,
  round(sqrt(n_a + n_b), 6) as limit_dist from pr""", ctes=_NEXT_BOOK)
def euclidean_limit(spark, sf):
    p = _next_book_overlap(tables(spark, sf))
    return p.select(
        "book_id", "other_id",
        r6(F.sqrt(vec.multihot_sq_euclidean("n_a", "n_b", "n_ab"))).alias("dist"),
        r6(F.sqrt(F.col("n_a") + F.col("n_b"))).alias("limit_dist"),
    )


@q("cosine_distance", """select book_id, other_id, round(1 - n_ab / nullif(sqrt(n_a * n_b), 0), 6) as dist from pr""", ctes=_NEXT_BOOK)
def cosine_distance(spark, sf):
    p = _next_book_overlap(tables(spark, sf))
    return p.select("book_id", "other_id", r6(vec.multihot_cosine_distance("n_a", "n_b", "n_ab")).alias("dist"))


@q("hamming", """select book_id, other_id, cast(n_a + n_b - 2 * n_ab as integer) as dist from pr""", ctes=_NEXT_BOOK)
def hamming(spark, sf):
    t = tables(spark, sf)
    dense, width = tag_vectors(t)
    books = rec_vectors(t.books().select(F.col("id").alias("book_id")), dense, width)
    a = books.select("book_id", F.col("vec").alias("a"))
    b = books.select(F.col("book_id").alias("other_id"), F.col("vec").alias("b"))
    p = a.join(b, F.col("other_id") == F.col("book_id") + 1)
    return p.select("book_id", "other_id", vec.hamming("a", "b").alias("dist"))


def rec_vectors(books: DataFrame, dense: DataFrame, width: int) -> DataFrame:
    from shelfwise.plans.recommend import with_vectors

    return with_vectors(books, dense, width)


@q("pairwise_overlap_summary", """with df as (select tag_id, count(*) as df from fx_set group by tag_id),
mo as (select s.book_id, sum(df.df) / (select count(distinct book_id) from fx_set) as v from fx_set s join df on df.tag_id = s.tag_id group by s.book_id)
select count(v) as "count", round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, round(min(v), 6) as min,
  round(quantile_cont(v, 0.25), 6) as p25, round(quantile_cont(v, 0.5), 6) as p50, round(quantile_cont(v, 0.75), 6) as p75,
  round(max(v), 6) as max from mo""")
def pairwise_overlap_summary(spark, sf):
    from shelfwise.operators.distances import mean_overlap

    mo = mean_overlap(model_tags(tables(spark, sf))[3])
    d = agg.describe_column(mo, ["mean_overlap"]).drop("column")
    return _r6_all(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


FIRST_BOOKS = 1000  # fixed value of the reference workflow


@q("pairwise_overlap_first", """with first as (select distinct book_id from fx_set order by book_id limit 1000),
st as (select * from fx_set where book_id in (select book_id from first)),
df as (select tag_id, count(*) as df from st group by tag_id),
mo as (select s.book_id, sum(df.df) / (select count(*) from first) as v from st s join df on df.tag_id = s.tag_id group by s.book_id)
select count(v) as "count", round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, round(min(v), 6) as min,
  round(quantile_cont(v, 0.25), 6) as p25, round(quantile_cont(v, 0.5), 6) as p50, round(quantile_cont(v, 0.75), 6) as p75,
  round(max(v), 6) as max from mo""")
def pairwise_overlap_first(spark, sf):
    """The same summary for the matrix of the first 1000 books."""
    from shelfwise.operators.distances import mean_overlap

    mo = mean_overlap(model_tags(tables(spark, sf))[3], FIRST_BOOKS)
    d = agg.describe_column(mo, ["mean_overlap"]).drop("column")
    return _r6_all(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


# ---------------------------------------------------------------- UBCF and user comparison
@q("user_similarity", """select g1.user_id, g2.user_id as other_user, count(*) as n_common
from fx_good g1 join fx_good g2 on g2.book_id = g1.book_id and g2.user_id <> g1.user_id
where g1.user_id = (select user_id from fx_user) group by g1.user_id, g2.user_id""")
def user_similarity(spark, sf):
    t = tables(spark, sf)
    return collab.user_similarity(flagged(t), chosen_user(t))


@q("ubcf_recommend", """with peers as (select g2.user_id as other_user, count(*) as n from fx_good g1 join fx_good g2
  on g2.book_id = g1.book_id and g2.user_id <> g1.user_id where g1.user_id = (select user_id from fx_user)
  group by g2.user_id order by n desc, other_user limit 10)
select f.book_id, round(avg(f.rating), 6) as mean_rating, count(*) as n_raters from fx_flag f
where f.user_id in (select other_user from peers) and f.book_id not in (select book_id from fx_mine)
group by f.book_id order by avg(f.rating) desc, n_raters desc, f.book_id limit 10""")
def ubcf_recommend(spark, sf):
    t = tables(spark, sf)
    return collab.ubcf_recommend(flagged(t), chosen_user(t), 10, 10).withColumn("mean_rating", r6("mean_rating"))


@q("user_compare", f"""select c.book_id, b.title, c.rating as rating_y from fx_clean c join fx_books b on b.id = c.book_id
where c.user_id = {_PEER_SQL} and c.rating = 5 and c.book_id not in (select book_id from fx_mine)""")
def user_compare(spark, sf):
    t = tables(spark, sf)
    pred = _compared(t).where(F.col("rating_x").isNull() & (F.col("rating_y") == 5))
    titles = t.books().select(F.col("id").alias("book_id"), "title")
    return pred.join(titles, "book_id").select("book_id", "title", "rating_y")


# ---------------------------------------------------------------- 2.12 kNN and the content-based recommendation
from shelfwise.operators import neighbors as nbrs  # noqa: E402
from shelfwise.plans import recommend as rec  # noqa: E402


def model_tags(t: Tables):
    """Inputs of the model queries, built once per query: the normalised book tags (written to
    the checkpoint folder), the kept tags resolved to a list (bounded by the top-n limit), the
    per-book 0/1 vectors (written) and the distinct (book, kept tag) set."""
    def build():
        nt, kl, tag_set = tag_rows(t)
        return nt, kl, materialize(feat.dense_tag_arrays(nt, kl)), tag_set

    return t.memo("model_tags", build)


def tag_rows(t: Tables):
    """The parts of :func:`model_tags` that need no vectors."""
    def build():
        nt = materialize(norm_tags(t))
        kl = feat.resolve_kept(feat.kept_tags(nt, t.tags()))
        tag_set = materialize(nt.where(F.col("tag_id").isin([tid for tid, _ in kl])).select("book_id", "tag_id").distinct())
        return nt, kl, tag_set

    return t.memo("tag_rows", build)


def tag_vectors(t: Tables, with_terms: bool = False):
    """Dense 0/1 arrays over the kept tags (books with at least one kept tag) and their width
    (and the kept tag ids)."""
    _, kl, vecs, _ = model_tags(t)
    if with_terms:
        return vecs, len(kl), [tid for tid, _ in kl]
    return vecs, len(kl)


def knn_scores_tags(t: Tables) -> DataFrame:
    vecs, width = tag_vectors(t)
    return rec.knn_scores(flagged(t), t.books(), vecs, width, chosen_user(t), k=2, weights="distance", mine=chosen_flags(t))


_KNN_CTES = """nbk as (select book_id, count(*) as n from fx_set group by book_id),
cand as (select c.book_id from (select book_id, avg(good) as m from fx_flag where book_id not in (select book_id from fx_mine)
         group by book_id order by m desc, book_id limit 1000) c where c.book_id in (select id from fx_books)),
ov as (select x.book_id as qid, y.book_id as tid, count(*) as n_ab from fx_set x join fx_set y on y.tag_id = x.tag_id
       where y.book_id in (select book_id from fx_mine) group by 1, 2),
pairs as (select c.book_id as qid, m.book_id as tid, m.good as label,
          coalesce(a.n, 0) + coalesce(b.n, 0) - 2 * coalesce(ov.n_ab, 0) as d2
   from cand c cross join fx_mine m left join nbk a on a.book_id = c.book_id left join nbk b on b.book_id = m.book_id
   left join ov on ov.qid = c.book_id and ov.tid = m.book_id),
top2 as (select * from (select *, sqrt(d2) as dist, row_number() over (partition by qid order by d2, tid) as rk from pairs) r where rk <= 2),
hz as (select qid, max(case when d2 = 0 then 1 else 0 end) as hz, avg(dist) as dist from top2 group by qid),
sc as (select t.qid, t.label, sum(case when h.hz = 1 then (case when t.d2 = 0 then 1.0 else 0.0 end) else 1.0 / t.dist end) as score
       from top2 t join hz h on h.qid = t.qid group by t.qid, t.label),
pr as (select qid, label as pred from (select *, row_number() over (partition by qid order by score desc, label) as rk from sc) s where rk = 1),
scores as (select p.qid as book_id, p.pred, h.dist from pr p join hz h on h.qid = p.qid),
recs as (select s.book_id, s.pred, s.dist, b.title from scores s join fx_books b on b.id = s.book_id where s.pred = 1
         order by round(s.dist, 9), s.book_id limit 10)"""


@q("mean_neighbor_distance", "select book_id, pred, round(dist, 6) as dist from scores", ctes=_KNN_CTES)
def mean_neighbor_distance(spark, sf):
    return knn_scores_tags(tables(spark, sf)).withColumn("dist", r6("dist"))


def _knn_recs(t: Tables) -> DataFrame:
    return rec.knn_recommend(knn_scores_tags(t), t.books(), 10)


@q("knn_recommend", "select book_id, pred, round(dist, 6) as dist, title from recs", ctes=_KNN_CTES)
def knn_recommend(spark, sf):
    return _knn_recs(tables(spark, sf)).withColumn("dist", r6("dist"))


@q("validate_recommendations", """select coalesce(a.tag_name, p.tag_name) as tag_name, a.share as share_act, p.share as share_pred
from (select tag_name, round(count(tag_id) / (select count(*) from fx_mine), 6) as share from fx_long
      where book_id in (select book_id from fx_mine) group by tag_name order by count(tag_id) desc, tag_name limit 10) a
full join (select tag_name, round(count(tag_id) / (select count(*) from recs), 6) as share from fx_long
      where book_id in (select book_id from recs) group by tag_name order by count(tag_id) desc, tag_name limit 10) p
on a.tag_name = p.tag_name""", ctes=_KNN_CTES)
def validate_recommendations(spark, sf):
    t = tables(spark, sf)
    recs = _knn_recs(t)
    mine = flagged(t).where(F.col("user_id") == chosen_user(t)).select("book_id")
    out = rec.validate_tag_shares(recs, mine, long_tags(t), 10)
    return out.withColumns({"share_act": r6("share_act"), "share_pred": r6("share_pred")})


@q("validate_membership", """select r.book_id,
  r.book_id in (select book_id from fx_to_read where user_id = (select user_id from fx_user)) as in_to_read,
  r.book_id in (select book_id from (select book_id, avg(good) as m from fx_flag where book_id not in (select book_id from fx_mine)
                group by book_id order by m desc, book_id limit 100) x) as in_top100
from recs r""", ctes=_KNN_CTES)
def validate_membership(spark, sf):
    t = tables(spark, sf)
    fl = flagged(t)
    user = chosen_user(t)
    mine = fl.where(F.col("user_id") == user)
    top_books = topk.top_unread_books(fl, mine, 1000)
    return rec.validate_membership(_knn_recs(t), t.to_read(), top_books, user, 100)


def _user_split(t: Tables, vectors=None):
    from shelfwise.operators.sampling import hash_split

    vecs, width = vectors or tag_vectors(t)
    mine = flagged(t).where(F.col("user_id") == chosen_user(t)).select("book_id", "good")
    split = hash_split(mine, "book_id", 0.2)
    data = materialize(rec.with_vectors(split, vecs, width))
    train = data.where(~F.col("is_test")).select(F.col("book_id").alias("tid"), "vec", F.col("good").alias("label"))
    test = data.where(F.col("is_test")).select(F.col("book_id").alias("qid"), "vec", F.col("good").alias("label"))
    return train, test


_SPLIT_CTES = f"""nbk as (select book_id, count(*) as n from fx_set group by book_id),
sp as (select book_id, good, {hash_sql('book_id', sampling.SPLIT_SEED)} < 858993459 as is_test from fx_mine),
tr as (select book_id, good from sp where not is_test), te as (select book_id, good from sp where is_test),
ov as (select x.book_id as qid, y.book_id as tid, count(*) as n_ab from fx_set x join fx_set y on y.tag_id = x.tag_id group by 1, 2),
pairs as (select q.book_id as qid, q.good as y, t.book_id as tid, t.good as label,
          coalesce(a.n, 0) + coalesce(b.n, 0) - 2 * coalesce(ov.n_ab, 0) as d2
  from te q cross join tr t left join nbk a on a.book_id = q.book_id left join nbk b on b.book_id = t.book_id
  left join ov on ov.qid = q.book_id and ov.tid = t.book_id),
rk as (select *, sqrt(d2) as dist, row_number() over (partition by qid order by d2, tid) as r from pairs)"""


@q("tune_curve", """select k, round(avg(case when (case when n1 > n0 then 1 else 0 end) = y then 1.0 else 0.0 end), 6) as accuracy
from (select qid, y, k, sum(label) as n1, count(*) - sum(label) as n0
      from rk join (select unnest(range(1, 20)) as k) ks on rk.r <= ks.k group by qid, y, k) v group by k""", ctes=_SPLIT_CTES)
def tune_curve(spark, sf):
    train, test = _user_split(tables(spark, sf))
    nb = nbrs.knn_neighbors(test, train, 19)
    acc = nbrs.prefix_accuracy(nb, train, test, 19)
    return acc.select(F.col("k").cast("bigint").alias("k"), r6("accuracy").alias("accuracy"))


@q("confusion_matrix", """with top2 as (select * from rk where r <= 2),
hz as (select qid, max(case when d2 = 0 then 1 else 0 end) as hz from top2 group by qid),
sc as (select t.qid, t.label, sum(case when h.hz = 1 then (case when t.d2 = 0 then 1.0 else 0.0 end) else 1.0 / t.dist end) as score
       from top2 t join hz h on h.qid = t.qid group by t.qid, t.label),
pr as (select s.qid, s.label as pred from (select *, row_number() over (partition by qid order by score desc, label) as o from sc) s where o = 1),
j as (select p.pred, te.good as y from pr p join te on te.book_id = p.qid)
select pred, count(*) filter (where y = 0) as actual_0, count(*) filter (where y = 1) as actual_1 from j group by pred""", ctes=_SPLIT_CTES)
def confusion_matrix(spark, sf):
    train, test = _user_split(tables(spark, sf))
    nb = nbrs.knn_neighbors(test, train, 2)
    scored = nbrs.vote(nb, train.select("tid", "label"), weights="distance")
    j = scored.join(test.select("qid", "label"), "qid")
    return metrics.confusion_matrix(j, "pred", "label", (0, 1))


def _emb_split(t: Tables):
    from shelfwise.operators.sampling import hash_split

    e = hash_split(t.embeddings(), "vec_id", 0.2)
    vecd = F.transform("embedding", lambda x: x.cast("double")).alias("vec")
    train = e.where(~F.col("is_test")).select(F.col("vec_id").alias("tid"), vecd, "label")
    test = e.where(F.col("is_test")).select(F.col("vec_id").alias("qid"), vecd, "label")
    return train, test


_EMB_KNN = f"""el as (select vec_id, label, unnest(generate_series(0, len(embedding) - 1)) as dim,
                 cast(unnest(embedding) as double) as value from embeddings),
es as (select vec_id, label, {hash_sql('vec_id', sampling.SPLIT_SEED)} < 858993459 as is_test from embeddings),
d as (select a.vec_id as qid, b.vec_id as tid, sum(power(a.value - b.value, 2)) as d2
      from el a join el b on b.dim = a.dim
      where a.vec_id in (select vec_id from es where is_test) and b.vec_id in (select vec_id from es where not is_test)
      group by a.vec_id, b.vec_id),
nb as (select d.*, l.label from (select *, row_number() over (partition by qid order by d2, tid) as r from d) d
       join es l on l.vec_id = d.tid where r <= 5),
pr as (select qid, label as pred from (select qid, label, row_number() over (partition by qid order by count(*) desc, label) as o
       from nb group by qid, label) x where o = 1),
cls as (select p.qid as vec_id, p.pred, e.label from pr p join es e on e.vec_id = p.qid)"""


def _knn_classify(spark, sf) -> DataFrame:
    train, test = _emb_split(tables(spark, sf))
    nb = nbrs.knn_neighbors(test, train, 5)
    scored = nbrs.vote(nb, train.select("tid", "label"), weights="uniform")
    return scored.join(test.select("qid", "label"), "qid").select(F.col("qid").alias("vec_id"), "pred", "label")


@q("knn_classify", "select vec_id, pred, label from cls", ctes=_EMB_KNN)
def knn_classify(spark, sf):
    return _knn_classify(spark, sf)


@q("accuracy", "select round(avg(case when pred = label then 1.0 else 0.0 end), 6) as accuracy from cls", ctes=_EMB_KNN)
def accuracy(spark, sf):
    return metrics.accuracy(_knn_classify(spark, sf), "pred", "label").withColumn("accuracy", r6("accuracy"))


# ---------------------------------------------------------------- 2.12 regression
from shelfwise.operators import regression as reg  # noqa: E402

# The reference's cross-validated LASSO alpha and its alpha grid (logspace(-4, -0.5, 30)).
LASSO_ALPHA = 0.00017433288221999874
LASSO_GRID = [10 ** (-4 + 3.5 * i / 29) for i in range(30)]
KKT_TOL = 1e-6


def _regression_inputs(t: Tables):
    vecs, _, terms = tag_vectors(t, with_terms=True)
    # one row per book: the fit, the certificate and R^2 all read the written copy
    design = materialize(reg.book_design(clean_ratings(t), vecs))
    return design, terms, vecs


def _zero(c) -> Column:
    """Round to 4 places and turn -0.0 into 0.0."""
    return F.round(c, 4) + F.lit(0.0)


@q("ols_fit", """select cast(0 as bigint) as term, count(*) as support, cast(0.0 as double) as grad from fx_clean where book_id in (select book_id from fx_set)
union all select s.tag_id as term, count(*) as support, cast(0.0 as double) as grad from fx_clean c join fx_set s on s.book_id = c.book_id group by s.tag_id""")
def ols_fit(spark, sf):
    """Certificate of the OLS fit: the raw-row gradient of every term (incl. intercept) is zero."""
    design, terms, _ = _regression_inputs(tables(spark, sf))
    model = reg.ols_fit(design)
    g = reg.gradient_table(design, model, terms)
    # mean residual over the rows carrying the term: scale-free, ~0 at the optimum
    return g.select("term", "support", (F.round(F.col("grad") / F.col("support"), 6) + F.lit(0.0)).alias("grad"))


@q("ols_coefficients")
def ols_coefficients(spark, sf):
    """OLS coefficients per term (intercept = term 0)."""
    design, terms, _ = _regression_inputs(tables(spark, sf))
    return reg.coefficient_table(spark, reg.ols_fit(design), terms)


@q("ols_inference")
def ols_inference(spark, sf):
    t = tables(spark, sf)
    _, kl, _, tag_set = model_tags(t)
    return reg.ols_inference(clean_ratings(t), tag_set, [tid for tid, _ in kl])


def _brand_design(t: Tables):
    """(ratings, (book_id, tag_id) of the brand tags, brand tags in name order): one 0/1 column per brand
    but the first. Every book has one brand, so the fit can be stated in SQL as group statistics."""
    brands = [(r["tag_id"], r["tag_name"]) for r in
              t.tags().where(F.col("tag_name").startswith("Brand#")).orderBy("tag_name").collect()]
    of_book = t.part_tags().where(F.col("tag_name").startswith("Brand#")).join(t.tags(), "tag_name")
    return clean_ratings(t), materialize(of_book.select(F.col("id").alias("book_id"), "tag_id")), brands


_BRAND = """rb as (select c.user_id, c.book_id, c.rating, p.p_brand as brand from fx_clean c join part p on p.p_partkey + 1 = c.book_id),
gb as (select brand, count(*) as n, avg(rating) as m from rb group by brand),
bs as (select n as n0, m as m0, brand as b0 from gb where brand = (select min(p_brand) from part)),
sg as (select sqrt(sum(power(rb.rating - gb.m, 2)) / (count(*) - (select count(*) from gb))) as s from rb join gb on gb.brand = rb.brand)"""


@q("ols_brand_inference", """select gb.brand as term, round(case when brand = b0 then m0 else m - m0 end, 6) as coef,
  round(s * sqrt(case when brand = b0 then 1.0 / n0 else 1.0 / n + 1.0 / n0 end), 6) as std_err,
  round((case when brand = b0 then m0 else m - m0 end) / (s * sqrt(case when brand = b0 then 1.0 / n0 else 1.0 / n + 1.0 / n0 end)), 4) as t_value
from gb cross join bs cross join sg""", ctes=_BRAND)
def ols_brand_inference(spark, sf):
    """OLS of the ratings on brand columns: the intercept stands for the first brand."""
    t = tables(spark, sf)
    ratings, of_book, brands = _brand_design(t)
    out = reg.ols_inference(ratings, of_book, [i for i, _ in brands[1:]], books=of_book.select("book_id"))
    names = spark.createDataFrame([(0, brands[0][1]), *brands[1:]], "term long, name string")  # one row per brand
    out = out.join(F.broadcast(names), "term")
    return out.select(F.col("name").alias("term"), r6("coef").alias("coef"), r6("std_err").alias("std_err"), F.round("t_value", 4).alias("t_value"))


def _brand_fitted(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings, brand of each book, and the fitted value of each brand (tag_id, fitted)."""
    ratings, of_book, brands = _brand_design(t)
    fit = reg.ols_inference(ratings, of_book, [i for i, _ in brands[1:]], books=of_book.select("book_id"))
    coef = {r["term"]: r["coef"] for r in fit.collect()}  # one number per brand
    rows = [(i, coef[0] + coef.get(i, 0.0)) for i, _ in brands]
    return ratings, of_book, t.spark.createDataFrame(rows, "tag_id long, fitted double")


@q("ols_brand_residuals", """select rb.user_id, rb.book_id, rb.rating, round(gb.m, 6) as fitted, round(rb.rating - gb.m, 6) + 0.0 as residual
from rb join gb on gb.brand = rb.brand""", ctes=_BRAND)
def ols_brand_residuals(spark, sf):
    """Fitted value and residual of every rating under the fit on brand columns."""
    t = tables(spark, sf)
    ratings, of_book, per_brand = _brand_fitted(t)
    j = ratings.join(of_book, "book_id").join(F.broadcast(per_brand), "tag_id")
    return j.select("user_id", "book_id", "rating", r6("fitted").alias("fitted"),
                    (r6(F.col("rating") - F.col("fitted")) + F.lit(0.0)).alias("residual"))


@q("ols_brand_predict_item", """select cast(18 as bigint) as book_id, round(max(gb.m), 6) as pred, count(rb.rating) as "count",
  round(avg(rb.rating), 6) as mean, round(stddev_samp(rb.rating), 6) as std, round(cast(min(rb.rating) as double), 6) as min,
  round(quantile_cont(rb.rating, 0.25), 6) as p25, round(quantile_cont(rb.rating, 0.5), 6) as p50,
  round(quantile_cont(rb.rating, 0.75), 6) as p75, round(cast(max(rb.rating) as double), 6) as max
from rb join gb on gb.brand = rb.brand where rb.book_id = 18""", ctes=_BRAND)
def ols_brand_predict_item(spark, sf):
    """Prediction for book 18 under the fit on brand columns next to the distribution of its actual ratings."""
    ratings, of_book, per_brand = _brand_fitted(tables(spark, sf))
    own = ratings.where(F.col("book_id") == 18)
    pred = own.join(of_book, "book_id").join(F.broadcast(per_brand), "tag_id").agg(F.max("fitted")).scalar()
    d = agg.describe_column(own.withColumn("rating", F.col("rating").cast("double")), ["rating"]).drop("column")
    out = d.select(F.lit(18).cast("long").alias("book_id"), r6(pred).alias("pred"), "*")
    return _r6_all(out, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@q("ols_predict_item")
def ols_predict_item(spark, sf):
    """Predicted rating of book 18 next to the distribution of its actual ratings."""
    t = tables(spark, sf)
    design, _, _ = _regression_inputs(t)
    model = reg.ols_fit(design)
    pred = model.transform(design.where(F.col("book_id") == 18)).select("prediction").scalar()
    actual = agg.describe_column(clean_ratings(t).where(F.col("book_id") == 18), ["rating"]).drop("column")
    return actual.select(F.lit(18).cast("long").alias("book_id"), pred.alias("pred"), "*")


@q("ols_r_squared")
def ols_r_squared(spark, sf):
    design, _, _ = _regression_inputs(tables(spark, sf))
    return reg.r_squared_raw(design, reg.ols_fit(design))


@q("r_squared", """select round(1 - sum(power(c.rating - m.m, 2)) / sum(power(c.rating - (select avg(rating) from fx_clean), 2)), 6) as r2
from fx_clean c join (select book_id, avg(rating) as m from fx_clean group by book_id) m on m.book_id = c.book_id""")
def r_squared(spark, sf):
    """R^2 of the per-book mean rating (the OLS fit on book dummies) over the raw rows."""
    c = clean_ratings(tables(spark, sf))
    pred = c.join(c.groupBy("book_id").agg(F.avg("rating").alias("m")), "book_id")
    return metrics.r_squared(pred, "m", "rating").withColumn("r2", r6("r2"))


@q("lasso_fit", "select cast(0 as bigint) as term, true as kkt_ok union all select tag_id as term, true as kkt_ok from fx_kept")
def lasso_fit(spark, sf):
    """KKT certificate of the L1 fit at the reference alpha: every term satisfies its condition."""
    design, terms, _ = _regression_inputs(tables(spark, sf))
    model = reg.lasso_fit(design, LASSO_ALPHA)
    return reg.kkt_table(design, model, terms, LASSO_ALPHA, KKT_TOL).select("term", "kkt_ok")


@q("lasso_coefficients")
def lasso_coefficients(spark, sf):
    design, terms, _ = _regression_inputs(tables(spark, sf))
    return reg.coefficient_table(spark, reg.lasso_fit(design, LASSO_ALPHA), terms)


@q("lasso_cv")
def lasso_cv(spark, sf):
    """5-fold CV of R^2 over the 30-alpha grid from one pass of per-fold sufficient statistics."""
    _, stats = _fold_stats(tables(spark, sf))
    return spark.createDataFrame(reg.lasso_cv(stats, LASSO_GRID), "alpha double, mean_score double, std_score double, std_error double")


def _fold_stats(t: Tables):
    _, kl, tag_set = tag_rows(t)
    terms = [tid for tid, _ in kl]
    folded = clean_ratings(t).withColumn("fold", F.floor(hash_pair_u32("user_id", "book_id") * 5 / F.lit(1 << 32)).cast("int"))
    return terms, reg.fold_statistics(folded, tag_set, terms)


@q("lasso_best_alpha")
def lasso_best_alpha(spark, sf):
    """The cross-validated alpha and the coefficients that the refit on all rows keeps."""
    _, stats = _fold_stats(tables(spark, sf))
    rows = reg.lasso_cv(stats, LASSO_GRID)
    alpha = reg.best_alpha(rows)
    s = reg.total_statistics(stats)
    beta = reg.lasso_gram(s["G"], s["c"], s["n"], alpha)
    score = next(r[1] for r in rows if r[0] == alpha)
    return spark.createDataFrame([(alpha, score, int((beta[1:] != 0).sum()), reg.r2_from_stats(beta, s))],
                                 "alpha double, mean_score double, n_active int, r2 double")


@q("lasso_refit", "select cast(0 as bigint) as term, true as kkt_ok union all select tag_id as term, true as kkt_ok from fx_kept")
def lasso_refit(spark, sf):
    """KKT certificate of the refit at the best alpha: every term satisfies its condition."""
    terms, stats = _fold_stats(tables(spark, sf))
    alpha = reg.best_alpha(reg.lasso_cv(stats, LASSO_GRID))
    s = reg.total_statistics(stats)
    ok = reg.kkt_ok(reg.lasso_gram(s["G"], s["c"], s["n"], alpha), s, alpha, KKT_TOL)
    return spark.createDataFrame([(int(i), bool(x)) for i, x in zip([0, *terms], ok)], "term long, kkt_ok boolean")


@q("lasso_path", "select alpha, 1 + (select count(*) from fx_kept) as n_terms, true as kkt_ok from (select unnest(range(1, 31)) as alpha) x")
def lasso_path(spark, sf):
    """KKT certificate of the whole path on all rows: for the 30 alphas of the grid (numbered from the smallest)
    every term satisfies its condition."""
    terms, stats = _fold_stats(tables(spark, sf))
    s = reg.total_statistics(stats)
    path = reg.lasso_path(s, LASSO_GRID)
    rows = [(i, len(terms) + 1, bool(reg.kkt_ok(path[a], s, a, KKT_TOL).all())) for i, a in enumerate(LASSO_GRID, 1)]
    return spark.createDataFrame(rows, "alpha long, n_terms long, kkt_ok boolean")


# ---------------------------------------------------------------- 2.12 PCA
from shelfwise.operators import decompose as dec  # noqa: E402
from shelfwise.operators import products  # noqa: E402

PCA_SHARE = 0.015


def _pca(t: Tables):
    vecs, width, terms = tag_vectors(t, with_terms=True)
    fit = dec.PcaFit(vecs, width)
    return vecs, terms, fit


@q("pca_covariance", """with n as (select count(distinct book_id) as n from fx_set),
ni as (select tag_id, count(*) as c from fx_set group by tag_id),
co as (select a.tag_id as ti, b.tag_id as tj, count(*) as nij from fx_set a join fx_set b on a.book_id = b.book_id group by 1, 2)
select co.ti, co.tj, round((co.nij - a.c * b.c / n.n) / (n.n - 1), 6) as cov
from co join ni a on a.tag_id = co.ti join ni b on b.tag_id = co.tj cross join n""")
def pca_covariance(spark, sf):
    s = feat.book_tag_set(long_tags(tables(spark, sf)))
    return dec.covariance_long(s).withColumn("cov", r6("cov"))


@q("topk_abs_per_group", """with n as (select count(distinct book_id) as n from fx_set),
ni as (select tag_id, count(*) as c from fx_set group by tag_id),
co as (select a.tag_id as ti, b.tag_id as tj, count(*) as nij from fx_set a join fx_set b on a.book_id = b.book_id
       where a.tag_id <> b.tag_id group by 1, 2),
cv as (select a.tag_id as ti, b.tag_id as tj, (coalesce(co.nij, 0) - a.c * b.c / n.n) / (n.n - 1) as cov
       from ni a join ni b on a.tag_id <> b.tag_id left join co on co.ti = a.tag_id and co.tj = b.tag_id cross join n)
select ti, tj, round(cov, 6) as cov, cast(rk as integer) as rank from
  (select *, row_number() over (partition by ti order by abs(cov) desc, tj) as rk from cv) x where rk <= 5""")
def topk_abs_per_group(spark, sf):
    """Per tag, the 5 other tags with the largest |covariance| (ties by id), tags that never share a book included."""
    s = feat.book_tag_set(long_tags(tables(spark, sf)))
    cov = dec.covariance_long(s, all_pairs=True).where(F.col("ti") != F.col("tj"))
    out = topk.topk_abs_per_group(cov, "ti", "cov", "tj", 5)
    return out.select("ti", "tj", r6("cov").alias("cov"), "rank")


@q("pca_fit")
def pca_fit(spark, sf):
    """Explained-variance share of every component."""
    _, _, fit = _pca(tables(spark, sf))
    return dec.variance_table(spark, fit.ratios)


@q("pca_select")
def pca_select(spark, sf):
    """Components whose explained-variance share exceeds 0.015."""
    _, _, fit = _pca(tables(spark, sf))
    return dec.variance_table(spark, fit.ratios).where(F.col("ratio") > PCA_SHARE)


@q("pca_loadings")
def pca_loadings(spark, sf):
    """Top 5 tags by |loading| for each kept component, with names."""
    t = tables(spark, sf)
    _, terms, fit = _pca(t)
    n_comp = dec.select_components(fit.ratios, PCA_SHARE)
    lt = dec.loadings_table(spark, fit.pc, terms, n_comp).join(t.tags(), "tag_id")
    return topk.topk_abs_per_group(lt, "component", "loading", "tag_name", 5).select("component", "rank", "tag_name", "loading")


@q("pca_certificate", """select cast(row_number() over (order by tag_id) as integer) as component, true as eigen_ok, true as ratios_ok from fx_kept""")
def pca_certificate(spark, sf):
    """Per component: covariance x vector = eigenvalue x vector against the covariance counted from tag
    pairs, and the shares add up to 1."""
    t = tables(spark, sf)
    _, terms, fit = _pca(t)
    at = {tid: i for i, tid in enumerate(terms)}
    s = model_tags(t)[3]
    n = s.select("book_id").distinct().count()
    ni = {r["tag_id"]: r["c"] for r in s.groupBy("tag_id").agg(F.count(F.lit(1)).alias("c")).collect()}  # p rows
    cov = dec.np.array([[-ni.get(a, 0) * ni.get(b, 0) / n / (n - 1) for b in terms] for a in terms])
    for r in dec.covariance_long(s).collect():  # at most p^2 rows
        cov[at[r["ti"]], at[r["tj"]]] = r["cov"]
    values = fit.ratios * cov.trace()
    off = dec.np.abs(cov @ fit.pc - fit.pc * values).max(axis=0) / values.max()
    total = abs(fit.ratios.sum() - 1) < 1e-9
    return spark.createDataFrame([(i + 1, bool(x < 1e-9), bool(total)) for i, x in enumerate(off)],
                                 "component int, eigen_ok boolean, ratios_ok boolean")


@q("pca_transform", "select cast(0.0 as double) as max_offdiag_cov, true as diagonal_is_variance")
def pca_transform(spark, sf):
    """Certificate of the centred projection: the scores' covariance matrix is diagonal, and its diagonal
    holds the components' variances (none of them zero)."""
    t = tables(spark, sf)
    vecs, _, fit = _pca(t)
    n_comp = max(2, dec.select_components(fit.ratios, PCA_SHARE))
    scores = materialize(fit.scores(vecs, n_comp))
    ex = scores.select("book_id", F.posexplode("vec").alias("i", "xi"), "vec").select(
        "book_id", "i", "xi", F.posexplode("vec").alias("j", "xj")).where(F.col("i") <= F.col("j"))
    cov = ex.groupBy("i", "j").agg((F.sum(F.col("xi") * F.col("xj")) / (F.count(F.lit(1)) - 1)).alias("c"))
    # all variances, from the raw vectors: the shares are of their sum
    el = vecs.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("v"))
    total = el.agg(F.sum("v")).scalar()
    share = F.get(F.array(*[F.lit(float(x)) for x in fit.ratios[:n_comp]]), F.col("i"))
    on = F.col("i") == F.col("j")
    right = (F.col("c") > 0) & (F.abs(F.col("c") - share * total) <= 1e-9 * total)
    cov = cov.withColumn("_right", right | ~on)
    return cov.agg((F.round(F.max(F.when(~on, F.abs("c"))), 6) + F.lit(0.0)).alias("max_offdiag_cov"),
                   F.bool_and("_right").alias("diagonal_is_variance"))


@q("tune_curve_pca")
def tune_curve_pca(spark, sf):
    """Accuracy for k = 1..19 on the PCA scores of the chosen user's books."""
    t = tables(spark, sf)
    vecs, _, fit = _pca(t)
    n_comp = dec.select_components(fit.ratios, PCA_SHARE)
    train, test = _user_split(t, (materialize(fit.scores(vecs, n_comp)), n_comp))
    acc = nbrs.prefix_accuracy(nbrs.knn_neighbors(test, train, 19), train, test, 19)
    return acc.select(F.col("k").cast("bigint").alias("k"), r6("accuracy").alias("accuracy"))


@q("validate_membership_pca")
def validate_membership_pca(spark, sf):
    """Are the PCA-based recommendations on the user's to-read list, and among the 100 best candidates?"""
    t = tables(spark, sf)
    fl = written_flags(t)
    user = chosen_user(t)
    top_books = topk.top_unread_books(fl, fl.where(F.col("user_id") == user), 1000)
    return rec.validate_membership(_knn_recommend_pca(t), t.to_read(), top_books, user, 100)


@q("knn_recommend_pca")
def knn_recommend_pca(spark, sf):
    """The kNN recommendation on centred PCA scores instead of raw tags."""
    return _knn_recommend_pca(tables(spark, sf))


def _knn_recommend_pca(t: Tables) -> DataFrame:
    vecs, _, fit = _pca(t)
    n_comp = dec.select_components(fit.ratios, PCA_SHARE)
    scores = fit.scores(vecs, n_comp)
    sc = rec.knn_scores(flagged(t), t.books(), scores, n_comp, chosen_user(t), k=2, weights="distance", mine=chosen_flags(t))
    return rec.knn_recommend(sc, t.books(), 10)


# ---------------------------------------------------------------- 2.12 clustering, SVD, factorisation
from shelfwise.operators import cluster as clu  # noqa: E402

KMEANS_K = 3
SVD_K = 10
SVD_TOL = 1e-6


def _kmeans(t: Tables, ks):
    fl = written_flags(t)
    good = materialize(collab.good_rows(fl))
    users = materialize(clean.id_spine(fl, "user_id"))
    return good, users, *clu.kmeans(good, users, ks)


@q("kmeans_fit")
def kmeans_fit(spark, sf):
    """Cluster sizes of k-means (k = 3) on users' good-book vectors (zero vectors included)."""
    _, _, assigned, _ = _kmeans(tables(spark, sf), [KMEANS_K])
    return clu.cluster_sizes(assigned)


@q("kmeans_elbow")
def kmeans_elbow(spark, sf):
    """Within-cluster SS for k = 1..10."""
    _, _, assigned, _ = _kmeans(tables(spark, sf), range(1, 11))
    return clu.inertia(assigned)


@q("kmeans_elbow_check", """select round(s.nnz - s.sq / u.n, 6) as inertia_k1, cast(10 as bigint) as n_k, true as not_increasing
from (select sum(nb) as nnz, sum(nb * nb) as sq from (select book_id, count(*) as nb from fx_good group by book_id) b) s
cross join (select max(user_id) as n from fx_flag) u""")
def kmeans_elbow_check(spark, sf):
    """The elbow curve starts at the total sum of squares and does not rise by more than 2 % from k to k + 1."""
    curve = kmeans_elbow(spark, sf)
    worse = F.col("inertia") > 1.02 * F.lag("inertia").over(_by("k"))  # ten rows
    return curve.withColumn("_up", F.coalesce(worse, F.lit(False))).agg(
        r6(F.max(F.when(F.col("k") == 1, F.col("inertia")))).alias("inertia_k1"), F.count(F.lit(1)).alias("n_k"),
        (~F.bool_or("_up")).alias("not_increasing"))


def _by(col):
    from pyspark.sql import Window

    return Window.orderBy(col)


@q("kmeans_step", """with firsts as (select user_id, cast(row_number() over (order by user_id) as integer) as cluster
                 from (select distinct user_id from fx_good order by user_id limit 3) x),
c0 as (select f.cluster, g.book_id, cast(1.0 as double) as v from fx_good g join firsts f on f.user_id = g.user_id),
norms as (select cluster, sum(v * v) as c2 from c0 group by cluster),
dots as (select g.user_id, c0.cluster, sum(c0.v) as dot from fx_good g join c0 on c0.book_id = g.book_id group by 1, 2),
users as (select unnest(range(1, (select max(user_id) from fx_flag) + 1)) as user_id),
nu as (select user_id, count(*) as nu from fx_good group by user_id),
d as (select u.user_id, n.cluster, coalesce(nu.nu, 0) + n.c2 - 2 * coalesce(dots.dot, 0) as d2
      from users u cross join norms n left join nu on nu.user_id = u.user_id
      left join dots on dots.user_id = u.user_id and dots.cluster = n.cluster),
best as (select user_id, cluster, d2 from (select *, row_number() over (partition by user_id order by d2, cluster) as rk from d) x
         where rk = 1)
select cluster, count(*) as size, round(sum(d2), 6) as sse from best group by cluster""")
def kmeans_step(spark, sf):
    """One assign step from the first three users' vectors: cluster sizes and within SS."""
    fl = flagged(tables(spark, sf))
    good = collab.good_rows(fl)
    users = clean.id_spine(fl, "user_id")
    best = clu.assign(good, users, clu.first_users_as_centers(good, [KMEANS_K]))
    return best.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), r6(F.sum("d2")).alias("sse"))


@q("scale_features", """select vec_id, cast(dim as integer) as dim, round((value - avg(value) over (partition by dim))
  / stddev_samp(value) over (partition by dim), 6) as z from el""", ctes=_EMB_LONG)
def scale_features(spark, sf):
    """Each embedding dimension standardised: (x - mean) / sample std."""
    el = _emb_long(tables(spark, sf))
    stats = el.groupBy("dim").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    # one row per dimension: bounded by the vector length
    j = el.join(F.broadcast(stats), "dim")
    return j.select("vec_id", "dim", r6(F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))).alias("z"))


def _entries(t: Tables) -> DataFrame:
    good = collab.good_rows(written_flags(t))
    return good.select(F.col("user_id").alias("row"), F.col("book_id").alias("col"), F.lit(1.0).alias("value"))


def _svd(t: Tables) -> dec.SvdResult:
    return t.memo("svd", lambda: dec.svd_krylov(_entries(t), SVD_K, tol=SVD_TOL))


@q("svd_fit")
def svd_fit(spark, sf):
    """Truncated SVD (10 factors) of the user x book good matrix: singular values, descending."""
    s = _svd(tables(spark, sf)).s
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(s)], "component int, singular_value double")


@q("svd_certificate", """select cast(unnest(range(1, 11)) as integer) as component, true as left_ok, true as right_ok,
  true as u_orthonormal, true as v_orthonormal, true as descending""")
def svd_certificate(spark, sf):
    """Per component: A v = s u and A^T u = s v to 1e-6 s, U and V orthonormal, values descending."""
    t = tables(spark, sf)
    c = dec.svd_certificate(_entries(t), _svd(t))
    s = [float(x) for x in _svd(t).s]
    below = F.array(*[F.lit(x) for x in [*s[1:], 0.0]])
    return c.select("component", (F.col("res_left") <= SVD_TOL).alias("left_ok"), (F.col("res_right") <= SVD_TOL).alias("right_ok"),
                    (F.col("ortho_u") <= 1e-9).alias("u_orthonormal"), (F.col("ortho_v") <= 1e-9).alias("v_orthonormal"),
                    (F.col("s") >= F.get(below, F.col("component") - 1)).alias("descending"))


@q("latent_nearest_user")
def latent_nearest_user(spark, sf):
    """The five users nearest to the chosen user in the SVD user factors U (users without good
    rows sit at the origin)."""
    return latent_nearest_user_of(tables(spark, sf))


def latent_nearest_user_of(t: Tables) -> DataFrame:
    fl = written_flags(t)
    u = _svd(t).u
    users = clean.id_spine(fl, "user_id")
    zero = F.array_repeat(F.lit(0.0), SVD_K)
    uu = users.join(u.withColumnRenamed("row", "user_id"), "user_id", "left").select(
        "user_id", F.coalesce("vec", zero).alias("vec"))
    uu = uu.checkpoint()
    me = uu.where(F.col("user_id") == chosen_user(t)).first()  # one row of 10 numbers
    mine = F.array(*[F.lit(float(x)) for x in (me["vec"] if me else [0.0] * SVD_K)])
    others = uu.where(F.col("user_id") != (me["user_id"] if me else -1))
    d = others.select("user_id", vec.euclidean("vec", mine).alias("dist"))
    return topk.top_n(d, [F.asc("dist"), F.asc("user_id")], 5)


def _latent_compared(t: Tables) -> DataFrame:
    """The chosen user's ratings beside those of the nearest user in the latent factors."""
    def build():
        row = latent_nearest_user_of(t).first()
        return row["user_id"] if row else None

    other = F.lit(t.memo("latent_peer", build)).cast("long")
    return collab.user_compare(written_flags(t), chosen_user(t), other)


@q("svd_recommend")
def svd_recommend(spark, sf):
    """Books the latent neighbour rated 5 and the chosen user has not rated, with titles."""
    t = tables(spark, sf)
    pred = _latent_compared(t).where(F.col("rating_x").isNull() & (F.col("rating_y") == 5))
    return pred.join(t.books().select(F.col("id").alias("book_id"), "title"), "book_id").select("book_id", "title", "rating_y")


@q("svd_user_rmse")
def svd_user_rmse(spark, sf):
    """RMSE between the two users over the books both rated (NULL when there is none), and their number."""
    both = _latent_compared(tables(spark, sf)).dropna()
    return metrics.rmse(both, "rating_x", "rating_y").select("rmse", both.agg(F.count(F.lit(1))).scalar().alias("n_both"))


@q("own_fives", """select m.book_id, b.title, m.rating from fx_mine m join fx_books b on b.id = m.book_id where m.rating = 5""")
def own_fives(spark, sf):
    """The chosen user's own books rated 5, with titles."""
    t = tables(spark, sf)
    mine = flagged(t).where((F.col("user_id") == chosen_user(t)) & (F.col("rating") == 5))
    return mine.join(t.books().select(F.col("id").alias("book_id"), "title"), "book_id").select("book_id", "title", "rating")


@q("factorize_ratings")
def factorize_ratings(spark, sf):
    """ALS factorisation of the observed ratings: train RMSE against the global-mean baseline."""
    c = written(clean_ratings(tables(spark, sf)), "ratings")
    als_rmse = metrics.rmse(dec.AlsFit(c).predict_fitted(), "prediction", "rating").withColumnRenamed("rmse", "rmse_als")
    mean = c.agg(F.avg("rating")).scalar()
    base = metrics.rmse(c.withColumn("m", mean), "m", "rating").withColumnRenamed("rmse", "rmse_mean")
    return als_rmse.select("rmse_als", base.select("rmse_mean").scalar().alias("rmse_mean"))


@q("factorize_certificate", "select count(distinct user_id) as n_users, true as normal_equations_hold from fx_clean")
def factorize_certificate(spark, sf):
    """Certificate of the factorisation's last half-step: every user's normal equations hold."""
    c = written(clean_ratings(tables(spark, sf)), "ratings")
    off = dec.AlsFit(c).user_gradients(c)
    return off.agg(F.count(F.lit(1)).alias("n_users"), F.bool_and(F.col("gradient") < 1e-5).alias("normal_equations_hold"))


FACTOR_TOP = 5


def _factor_top(c: DataFrame) -> products.TopProducts:
    fit = dec.AlsFit(c)
    return products.top_products(fit.user_factors(), fit.item_factors(), FACTOR_TOP, seen=c)


@q("factorize_recommend")
def factorize_recommend(spark, sf):
    """The five books without a rating of the user that the factors score highest, for every user."""
    return _factor_top(written(clean_ratings(tables(spark, sf)), "ratings")).rows


@q("factorize_recommend_check", f"""select user_id, least({FACTOR_TOP}, (select count(distinct book_id) from fx_clean) - count(*)) as n_books,
cast(0 as bigint) as n_rated from fx_clean group by user_id
having count(*) < (select count(distinct book_id) from fx_clean)""")
def factorize_recommend_check(spark, sf):
    """Books recommended to each user from the factors, and how many of these the user has rated."""
    c = written(clean_ratings(tables(spark, sf)), "ratings")
    mark = c.select("user_id", "book_id", F.lit(1).alias("_rated"))
    rows = _factor_top(c).rows.join(mark, ["user_id", "book_id"], "left")
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_books"), F.count("_rated").alias("n_rated"))


# ---------------------------------------------------------------- single metrics and the remaining views
@q("entropy", """select round(sum(-p * log2(p)), 6) as entropy
from (select count(*) / (select count(*) from fx_clean) as p from fx_clean group by rating) s""")
def entropy(spark, sf):
    return entropy_gini(spark, sf).select("entropy")


@q("gini", """select round(1 - sum(p * p), 6) as gini
from (select count(*) / (select count(*) from fx_clean) as p from fx_clean group by rating) s""")
def gini(spark, sf):
    return entropy_gini(spark, sf).select("gini")


@q("histogram_ratings", """with s as (select min(rating) as lo, max(rating) as hi from fx_clean),
b as (select least(cast(floor((rating - s.lo) * 10.0 / (s.hi - s.lo)) as bigint) + 1, 10) as bin from fx_clean, s)
select g.bin, round(s.lo + (g.bin - 1) * (s.hi - s.lo) / 10.0, 6) as lo, round(s.lo + g.bin * (s.hi - s.lo) / 10.0, 6) as hi, count(b.bin) as n
from (select unnest(range(1, 11)) as bin) g cross join s left join b on b.bin = g.bin group by g.bin, s.lo, s.hi""")
def histogram_ratings(spark, sf):
    """Ten equal-width bins over the cleaned ratings (the data behind the rating histogram)."""
    out = agg.histogram_equal_width(clean_ratings(tables(spark, sf)), "rating", 10)
    return out.withColumns({"bin": F.col("bin").cast("long"), "lo": r6("lo"), "hi": r6("hi")})


@q("validate_recommendations_pca")
def validate_recommendations_pca(spark, sf):
    """Tag shares of the user's books against the PCA-based recommendations (full outer)."""
    t = tables(spark, sf)
    recs = materialize(_knn_recommend_pca(t))
    mine = chosen_flags(t).select("book_id")
    out = rec.validate_tag_shares(recs, mine, long_tags(t), 10)
    return out.withColumns({"share_act": r6("share_act"), "share_pred": r6("share_pred")})


@q("kmeans_assignment", """select count(*) as n_users, count(*) as n_nearest, true as centers_are_means
from (select unnest(range(1, (select max(user_id) from fx_flag) + 1)) as user_id) u""")
def kmeans_assignment(spark, sf):
    """Certificate of the k-means fit (k = 3): every user's cluster is its nearest center, and every
    center is the mean of its users."""
    good, users, assigned, centers = _kmeans(tables(spark, sf), [KMEANS_K])
    out = clu.certificate(good, users, assigned, centers)
    return out.select("n_users", "n_nearest", (F.col("max_center_error") < 1e-12).alias("centers_are_means"))


@q("svd_energy", "select count(*) as frobenius_sq, true as captured_within_total from fx_good")
def svd_energy(spark, sf):
    """Certificate of the truncated SVD: the squared Frobenius norm of the good matrix and
    sum s^2 <= that norm (the 10 factors never capture more energy than the matrix holds)."""
    t = tables(spark, sf)
    captured = float((_svd(t).s ** 2).sum())
    good = collab.good_rows(written_flags(t))
    fro = good.agg(F.count(F.lit(1)).alias("frobenius_sq"))
    return fro.select("frobenius_sq", (F.lit(captured) <= F.col("frobenius_sq") * (1 + 1e-9)).alias("captured_within_total"))
