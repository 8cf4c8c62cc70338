"""Preference formatting (operator 10): DataFrame functions only.

The longest common turn prefix of a chosen and a rejected conversation is rendered once as the
prompt; what follows on either side is rendered as a completion, with the spans of it that
are trained on.  A conversation is gathered into one row (it becomes one string anyway); no
other group of rows is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is rendered.
OPEN, CLOSE = "<|", "|>\n"
END = "<|end|>\n"
TRAINED_ROLE = "assistant"


def gather(turns: DataFrame, key: str = "conv_id", name: str = "turns", owner: str | None = None) -> DataFrame:
    """One row per ``key`` with its turns in order, as an array of (role, text), and of the column ``owner`` first, if given.

    Order: turn, then role and text, so ties and repeated rows have a fixed order (all are kept).
    Null roles and texts count as empty; a null turn comes first; rows with a null key belong to no
    conversation and are left out.
    """
    first = [F.col(owner).cast("long").alias("owner")] if owner else []
    one = F.struct(*first, F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kept = [*(["owner"] if owner else []), "role", "text"]
    return (turns.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("pair_id"))
            .agg(F.transform(F.sort_array(F.collect_list(one)), lambda t: F.struct(*(t[c].alias(c) for c in kept))).alias(name)))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns are equal in role and text."""
    n = F.least(F.size(a), F.size(b))
    same = F.transform(F.arrays_zip(F.slice(a, 1, n).alias("x"), F.slice(b, 1, n).alias("y")), lambda p: (p["x"] == p["y"]).cast("string"))
    first = F.array_position(same, "false")
    return F.when(first > 0, first - 1).otherwise(n).cast("int")


def rendered(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))))


def rest(turns: Column, n: Column) -> Column:
    return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))


def trained_spans(turns: Column) -> Column:
    """Code-point spans start:end, joined by ;, of the trained turns' texts and end marks in their rendering."""
    head = F.length(F.lit(OPEN)) + F.length(F.lit(CLOSE))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + head + F.length(t["role"])
        end = begin + F.length(t["text"]) + F.length(F.lit(END))
        span = F.concat(begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: F.concat_ws(";", acc["spans"]))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """From (pair_id, chosen, rejected), arrays of (role, text), one row per pair: pair_id, prompt_turns,
    prompt, chosen, rejected (completions) and chosen_spans, rejected_spans.

    Equal conversations give a prompt of all turns and empty completions.  A null array counts as
    empty.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    pairs = pairs.select("pair_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    cut = pairs.withColumn("n", common_prefix(F.col("c"), F.col("r")))
    cut = cut.withColumn("cr", rest(F.col("c"), F.col("n"))).withColumn("rr", rest(F.col("r"), F.col("n")))
    return cut.select("pair_id", F.col("n").alias("prompt_turns"), rendered(F.slice("c", 1, F.col("n"))).alias("prompt"), rendered(F.col("cr")).alias("chosen"), rendered(F.col("rr")).alias("rejected"),
                      trained_spans(F.col("cr")).alias("chosen_spans"), trained_spans(F.col("rr")).alias("rejected_spans"))


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations, one for each, with all its turns: chosen, the conversation;
    rejected, its first k turns and then those that its neighbour (conv_id with its last bit flipped) has from
    there on, k being conv_id modulo the number of turns.  Without a neighbour, or with a shorter one, the rejected
    side ends after k turns.  Both conversations of a pair are gathered at once."""
    both = gather(turns.select(F.shiftright(F.col("conv_id").cast("long"), 1).alias("both"), "conv_id", "turn", "role", "text"), "both", owner="conv_id")
    side = lambda bit: F.transform(F.filter("turns", lambda t: F.pmod(t["owner"], F.lit(2)) == bit), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    pair = lambda bit, a, b: F.struct((2 * F.col("pair_id") + bit).alias("pair_id"), F.col(a).alias("turns"), F.col(b).alias("theirs"))
    sides = both.select("pair_id", side(0).alias("even"), side(1).alias("odd"))
    convs = sides.select(F.explode(F.array(pair(0, "even", "odd"), pair(1, "odd", "even"))).alias("p")).select("p.*").where(F.size("turns") > 0)
    k = F.pmod(F.col("pair_id"), F.size("turns")).cast("int")
    cut = convs.withColumn("k", k)
    return cut.select("pair_id", F.col("turns").alias("chosen"), F.concat(F.slice("turns", F.lit(1), F.col("k")), rest(F.col("theirs"), F.col("k"))).alias("rejected"))


#: The query over the whole table, for DuckDB: turns of both sides are compared one by one.
SQL = r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, count(*) over (partition by conv_id) as n,
         row_number() over (partition by conv_id order by turn nulls first, encode(coalesce(role, '')), encode(coalesce(text, ''))) as i
  from conversations where conv_id is not null),
ends as (select distinct conv_id, (conv_id % n + n) % n as k from t),
other as (
  select t.conv_id, i, role, text from t join ends using (conv_id) where i <= k
  union all select e.conv_id, t.i, t.role, t.text from ends e join t on t.conv_id = xor(e.conv_id, 1) where t.i > e.k),
pre as (
  select coalesce(a.conv_id, b.conv_id) as conv_id,
         coalesce(min(coalesce(a.i, b.i)) filter ((a.role = b.role and a.text = b.text) is not true) - 1, max(coalesce(a.i, b.i))) as p
  from t a full join other b on a.conv_id = b.conv_id and a.i = b.i group by 1),
line as (
  select side, conv_id, i, p, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as line
  from (select 'c' as side, conv_id, i, role, text from t union all select 'r', conv_id, i, role, text from other) join pre using (conv_id)),
placed as (
  select *, coalesce(sum(length(line)) over (partition by side, conv_id, i > p order by i rows between unbounded preceding and 1 preceding), 0) as head from line),
text as (
  select side, conv_id, string_agg(line, '' order by i) filter (i <= p) as prompt, string_agg(line, '' order by i) filter (i > p) as rest,
         string_agg(cast(head + 5 + length(role) as bigint) || ':' || cast(head + length(line) as bigint), ';' order by i) filter (i > p and role = 'assistant') as spans
  from placed group by all)
select pre.conv_id as pair_id, cast(p as integer) as prompt_turns, coalesce(c.prompt, '') as prompt, coalesce(c.rest, '') as chosen,
       coalesce(r.rest, '') as rejected, coalesce(c.spans, '') as chosen_spans, coalesce(r.spans, '') as rejected_spans
from pre left join text c on c.side = 'c' and c.conv_id = pre.conv_id left join text r on r.side = 'r' and r.conv_id = pre.conv_id
"""
