"""Chat formatting: cumulative snapshots collapse to their maximal conversations, which are rendered; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's fixed parts.
OPEN, AFTER_ROLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _clean(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, h1, h2 and nothing else. A null role or text is the empty one before it is hashed, so
    that turns that are rendered alike are equal; two seeds make 128 bits."""
    text = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return text.select("*", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, p1, p2, is_last: rolling hashes of the first pos turns, one row for each turn.

    Each turn's hashes are hashed again with its position, and the running exclusive or of those is the prefix's. Only
    hashes are dealt out by conversation, no text. Rows without a conv_id are conversations of one turn each, so they
    need no dealing out.
    """
    own = _clean(turns).select("conv_id", "turn", "h1", "h2")
    order = Window.partitionBy("conv_id").orderBy("turn", "h1", "h2")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = own.where("conv_id is not null").select("*", F.row_number().over(order).alias("pos"), F.lead(F.lit(1)).over(order).isNull().alias("is_last"))
    mixed = lambda h: F.xxhash64("pos", h)
    many = placed.select("conv_id", "pos", F.bit_xor(mixed("h1")).over(running).alias("p1"), F.bit_xor(mixed("h2")).over(running).alias("p2"), "is_last")
    alone = own.where("conv_id is null").withColumn("pos", F.lit(1))
    return many.unionByName(alone.select("conv_id", "pos", mixed("h1").alias("p1"), mixed("h2").alias("p2"), F.lit(True).alias("is_last")))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and the hashes p1, p2 of the conversations that no longer one begins with.

    Of equal conversations the one with the smallest id stays (a null id only where there is no other) and n_copies counts them.
    """
    rolled = prefixes(turns)
    whole = rolled.where("is_last").groupBy("pos", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    inner = rolled.where("not is_last").select("pos", "p1", "p2").distinct()
    return whole.join(inner, ["pos", "p1", "p2"], "left_anti").select("conv_id", F.col("pos").cast("long").alias("n_turns"), "n_copies", "p1", "p2")


def escaped(c: Column) -> Column:
    """Text in which no mark of the template can be read: a backslash parts `<` from `|im_`, one more where some stand
    there already, so that the text can be got back."""
    return F.regexp_replace(c, r"<(\\*)\|im_", r"<\\$1|im_")


def shown() -> Column:
    return F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(AFTER_ROLE), escaped(F.col("text")), F.lit(CLOSE))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, rendered of each maximal conversation.

    Turns stand in the order of their numbers (ties by hash, null numbers first); a null role or text is the empty one;
    a row without a conv_id is a conversation of one turn, and equal ones collapse like any others. Repeated rows are
    turns of their own. Marks of the template within roles and texts are escaped. An empty table gives no rows; other
    columns are not looked at.
    """
    kept, clean = maximal(turns), _clean(turns)
    parts = clean.where("conv_id is not null").select("conv_id", F.struct("turn", "h1", "h2", shown().alias("shown")).alias("t"))
    own = parts.join(kept.select("conv_id", "n_turns", "n_copies"), "conv_id")
    many = own.groupBy("conv_id").agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["shown"]), "").alias("rendered")
    )
    single = clean.where("conv_id is null").groupBy(F.xxhash64(F.lit(1), "h1").alias("p1"), F.xxhash64(F.lit(1), "h2").alias("p2")).agg(F.min(shown()).alias("rendered"))
    return many.unionByName(kept.where("conv_id is null").join(single, ["p1", "p2"]).select("conv_id", "n_turns", "n_copies", "rendered"))


ORACLE_SQL = r"""
with numbered as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         case when conv_id is null then 'n' || row_number() over () else 'c' || conv_id end as k from conversations
), pieces as (
  select *, md5(role || '|' || text) || md5(text) as piece from numbered
), rolled as (
  select k, conv_id, string_agg(piece, '') over (partition by k order by turn nulls first, piece rows unbounded preceding) as prefix,
         row_number() over (partition by k order by turn nulls first, piece) as pos, count(*) over (partition by k) as all_turns from pieces
), whole as (
  select prefix, min(conv_id) as conv_id, arg_min(k, coalesce(conv_id, 9223372036854775807)) as k, count(*) as n_copies, max(pos) as n_turns
  from rolled where pos = all_turns group by prefix
), kept as (
  select * from whole where prefix not in (select prefix from rolled where pos < all_turns)
)
select w.conv_id, w.n_turns, w.n_copies,
       string_agg('<|im_start|>' || regexp_replace(p.role, '<(\\*)\|im_', '<\\\1|im_', 'g') || chr(10)
                  || regexp_replace(p.text, '<(\\*)\|im_', '<\\\1|im_', 'g') || '<|im_end|>' || chr(10), '' order by p.turn nulls first, p.piece) as rendered
from kept w join pieces p on p.k = w.k group by w.k, w.conv_id, w.n_turns, w.n_copies
"""
