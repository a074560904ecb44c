"""Preference formatting (operator 1): the longest common turn prefix of a
chosen and a rejected conversation is rendered once as the prompt; what follows
in each is a completion with a loss mask.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``; ``<|`` inside a
role or text becomes ``< |``, so that no text can forge a marker.  A mask is a
run-length list of (characters, trained) over its completion: text and end
marker of assistant turns are trained, headers and other turns are not.

Null role: ``unknown``; null text: empty; null or empty conversation: no turns.
Equal conversations: everything is prompt, both completions are empty and
``tie`` is true.  Turns are compared by role and text.  Empty table: empty
result.  A conversation is one training example and so one row; it is the only
thing that is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"


def _safe(c: str) -> str:
    return f"replace({c}, '<|', '< |')"


def _clean(c: str) -> Column:
    return F.expr(f"transform(coalesce({c}, cast(array() as {TURNS})), t -> "
                  f"named_struct('role', coalesce(t.role, 'unknown'), 'text', coalesce(t.text, '')))")


def _render(turns: str) -> Column:
    return F.expr(f"array_join(transform({turns}, t -> concat('<|im_start|>', {_safe('t.role')}, '\\n', {_safe('t.text')}, '<|im_end|>\\n')), '')")


def _mask(turns: str) -> Column:
    """Header and line feed untrained, text and end marker of assistants trained."""
    head = f"named_struct('length', 13 + length({_safe('t.role')}), 'trained', false)"
    body = f"named_struct('length', length({_safe('t.text')}) + 10, 'trained', t.role = 'assistant')"
    tail = "named_struct('length', 1, 'trained', false)"
    return F.expr(f"flatten(transform({turns}, t -> array({head}, {body}, {tail})))")


def preference_format(df: DataFrame, id_col: str, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """(id, n_prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask, tie) for a table with two arrays of (role, text) turns."""
    rows = df.select(F.col(id_col), _clean(chosen).alias("c"), _clean(rejected).alias("r"))
    both = "least(size(c), size(r))"
    # the first turn that differs, over turn numbers only
    rows = rows.withColumn("n", F.expr(
        f"aggregate(slice(sequence(1, {both} + 1), 1, {both}), 0, (n, i) -> if(n = i - 1 and c[i - 1] = r[i - 1], i, n))"))
    rows = rows.select(id_col, F.col("n").cast("long").alias("n_prompt_turns"), F.expr("slice(c, 1, n)").alias("p"),
                       F.expr("slice(c, n + 1, size(c))").alias("c"), F.expr("slice(r, n + 1, size(r))").alias("r"))
    return rows.select(id_col, "n_prompt_turns", _render("p").alias("prompt"), _render("c").alias("chosen"), _render("r").alias("rejected"),
                       _mask("c").alias("chosen_mask"), _mask("r").alias("rejected_mask"),
                       ((F.size("c") == 0) & (F.size("r") == 0)).alias("tie"))


def preference_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs from the table conversations: chosen is a whole conversation, in
    the order of (turn, role, text), null turns last; rejected has its last
    assistant turn answered by the last assistant text of the conversation
    numbered one higher (empty if there is none) and ends there.  Without an
    assistant turn that answer is added.  Rows without a conv_id form one
    conversation."""
    turn = F.struct(F.col("turn").isNull().alias("late"), "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.select("conv_id", turn.alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    said = rows.where("t.role = 'assistant'").groupBy("conv_id").agg(F.max("t").getField("text").alias("answer"))
    said = said.where("conv_id is not null").select((F.col("conv_id") - 1).alias("conv_id"), "answer")
    turns = F.expr("transform(turns, t -> named_struct('role', t.role, 'text', t.text))")
    last = "aggregate(sequence(1, size(chosen)), size(chosen) + 1, (n, i) -> if(chosen[i - 1].role = 'assistant', i, n))"
    answer = F.array(F.struct(F.lit("assistant").alias("role"), F.coalesce("answer", F.lit("")).alias("text")))
    return (whole.join(said, "conv_id", "left").select("conv_id", turns.alias("chosen"), answer.alias("answer"))
            .select("conv_id", "chosen", F.concat(F.expr(f"slice(chosen, 1, {last} - 1)"), "answer").alias("rejected")))


def digest(conversations: DataFrame) -> DataFrame:
    """Query op1: texts whole, masks as ``length:trained`` lists."""
    out = preference_format(preference_pairs(conversations), "conv_id")
    flat = lambda c: F.expr(f"array_join(transform({c}, m -> concat(m.length, ':', cast(m.trained as int))), ',')")
    return out.withColumns({"chosen_mask": flat("chosen_mask"), "rejected_mask": flat("rejected_mask")})


SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS LAST, role, text) AS c FROM t GROUP BY 1),
said AS (
  SELECT conv_id - 1 AS conv_id, last(text ORDER BY turn NULLS LAST, text) AS answer
  FROM t WHERE role = 'assistant' AND conv_id IS NOT NULL GROUP BY 1),
pairs AS (
  SELECT whole.conv_id, c,
         list_concat(c[1:coalesce(list_max(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant')), len(c) + 1) - 1],
                     [{'role': 'assistant', 'text': coalesce(answer, '')}]) AS r
  FROM whole LEFT JOIN said USING (conv_id)),
cut AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1,
                     least(len(c), len(r))) AS n FROM pairs),
parts AS (SELECT conv_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM cut),
safe AS (
  SELECT conv_id, n,
    list_transform(p, lambda x: {'role': replace(x.role, '<|', '< |'), 'text': replace(x.text, '<|', '< |')}) AS p,
    list_transform(c, lambda x: {'role': replace(x.role, '<|', '< |'), 'text': replace(x.text, '<|', '< |')}) AS c,
    list_transform(r, lambda x: {'role': replace(x.role, '<|', '< |'), 'text': replace(x.text, '<|', '< |')}) AS r FROM parts)
SELECT conv_id, n::BIGINT AS n_prompt_turns,
  array_to_string(list_transform(p, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), '') AS prompt,
  array_to_string(list_transform(c, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), '') AS chosen,
  array_to_string(list_transform(r, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), '') AS rejected,
  array_to_string(list_transform(c, lambda x: (length(x.role) + 13) || ':0,' || (length(x.text) + 10) || ':' || (x.role = 'assistant')::INT || ',1:0'), ',') AS chosen_mask,
  array_to_string(list_transform(r, lambda x: (length(x.role) + 13) || ':0,' || (length(x.text) + 10) || ':' || (x.role = 'assistant')::INT || ',1:0'), ',') AS rejected_mask,
  len(c) = 0 AND len(r) = 0 AS tie
FROM safe
"""
