"""License scans: base phrases, and an exact set-similarity join with notice templates.

A text is cut into blocks: its lines, and its whole word sequence, so that a
notice wrapped over several lines lies in one block too. Of whatever has more
words than ``block_words`` of the templates, every window of that size at steps of half of it is
a block; it is twice the longest template at least, so no notice is ever cut. A block
matches a template when it holds at least ``THRESHOLD`` of the template's
distinct words. The join is exact:

* the templates' words are put in one global order, rarest in ``docs`` first;
* prefix filter: a matching block holds one of a template's first
  ``|T| - need + 1`` words, so only those words are index keys;
* length filter: it holds at least ``need`` of all template words;
* positional filter: at the first shared word, what follows it in the template
  and in the block must still reach ``need``;
* the survivors are counted exactly.

A block's labels are those of its templates. A template whose words are all in
another one that the block matches too (the notice with a further condition) counts only if
the block holds it beside that one: at least ``need`` of its words occur more often than the wider notice
can be there, which is as often as the words that only the wider one has.

Rows: one per input row. A null or empty text has no words, no places and no
labels, score 0. Repeated rows and ids each get their own row (matches are
joined by id and text hash). Other columns are ignored, so clashing names do
no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuity.llm.common import ascii_lower

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notice templates: (name, label, text).
TEMPLATES = [
    ("mit_short", "mit", "released under the mit license"),
    ("mit_line", "mit", "licensed under the mit license"),
    ("mit_grant", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
                         "software and associated documentation files"),
    ("apache_line", "apache", "licensed under the apache license version 2 0"),
    ("apache_notice", "apache", "you may not use this file except in compliance with the license you may obtain "
                                "a copy of the license at"),
    ("gpl_line", "gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl_notice", "gpl", "this program is free software you can redistribute it and or modify it under the terms "
                          "of the gnu general public license as published by the free software foundation"),
    ("bsd_notice", "bsd", "redistribution and use in source and binary forms with or without modification are "
                          "permitted provided that the following conditions are met"),
    ("cc_by", "cc-by", "licensed under cc by 4 0"),
    ("cc_by_nc", "cc-by-nc", "licensed under cc by nc 4 0"),
    ("mpl_notice", "mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved_bare", "all-rights-reserved", "all rights reserved"),
    ("reserved", "all-rights-reserved", "all rights reserved no part of this may be reproduced"),
]
THRESHOLD = 0.9
LEAST_BLOCK = 64
# Whatever separates words: all of ASCII but digits and (lower-case) letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def _template_words(templates) -> dict[str, list[str]]:
    return {name: sorted(set(text.split())) for name, _, text in templates}


def block_words(templates) -> int:
    """Words of a block: windows overlap by half, so the longest template lies in one whole."""
    return max(LEAST_BLOCK, *(2 * (len(text.split()) - 1) for _, _, text in templates))


def wider_templates(templates) -> dict[str, list[str]]:
    """For each template, those with all its words and more."""
    words = {name: set(ws) for name, ws in _template_words(templates).items()}
    return {a: sorted(b for b in words if words[a] < words[b]) for a in words}


def word_order(words: DataFrame, templates=TEMPLATES) -> list[str]:
    """The templates' words, those of fewest documents first.

    ``words``: a column ``words``. The result has one entry per template word,
    so what reaches the driver is bounded by the templates.
    """
    vocabulary = sorted({w for ws in _template_words(templates).values() for w in ws})
    counts = dict(words.select(F.explode(F.array_intersect(F.array(*map(F.lit, vocabulary)), "words")).alias("w"))
                  .groupBy("w").count().collect())
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def prefix_rows(order: list[str], threshold: float, templates=TEMPLATES) -> list[tuple]:
    """(word, its place in the template, template, label, the template's words in order, need) per prefix word."""
    rank, labels, rows = {w: i for i, w in enumerate(order)}, {n: x for n, x, _ in templates}, []
    for name, ws in _template_words(templates).items():
        ws = sorted(ws, key=rank.get)
        need = math.ceil(threshold * len(ws) - 1e-9)
        rows += [(ws[p], p, name, labels[name], ws, need) for p in range(len(ws) - need + 1)]
    return rows


def _blocks(text: Column, words: Column, size: int) -> Column:
    """The words of every block: lines and the whole text, either as overlapping windows where it is long."""
    step = size // 2
    lines = F.split(text, "\n")
    # A single line is the whole text.
    spans = F.concat(F.transform(lines, words_of), F.when(F.size(lines) > 1, F.array(words)).otherwise(F.array().cast("array<array<string>>")))
    cut = lambda ws: F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size(ws) - size) / step).cast("int"))),
        lambda i: F.slice(ws, i * step + 1, size))
    return F.flatten(F.transform(spans, cut))


def matching_blocks(docs: DataFrame, order: list[str], threshold: float = THRESHOLD,
                    templates=TEMPLATES) -> DataFrame:
    """Every (block, template) at or above the threshold.

    ``docs`` has doc_id, text and words. Columns: doc_id, text_hash, block, known
    (the block's template words), many (how often it has each), template, label, shared, containment. The index is bounded by the
    templates and is broadcast; blocks without an index word are dropped
    before it is met.
    """
    rows = prefix_rows(order, threshold, templates)
    index = docs.sparkSession.createDataFrame(
        rows, "word string, place int, template string, label string, template_words array<string>, need int")
    keys, vocabulary = F.array(*map(F.lit, sorted({r[0] for r in rows}))), F.array(*map(F.lit, order))
    blocks = (docs.where(F.arrays_overlap("words", keys))
              .select("doc_id", F.xxhash64("text").alias("text_hash"), 
                      F.posexplode(_blocks(F.col("text"), F.col("words"), block_words(templates))).alias("block", "ws"))
              .where(F.arrays_overlap("ws", keys))
              # The block's template words in the global order.
              .select("doc_id", "text_hash", "block", F.array_intersect(vocabulary, "ws").alias("known"), "ws"))
    blocks = blocks.withColumn("many", F.transform("known", lambda w: F.size(F.filter("ws", lambda x: x == w)))).drop("ws")
    pairs = (blocks.select("*", F.explode(F.array_intersect("known", keys)).alias("word"))
             .join(F.broadcast(index), "word")
             .where(F.size("known") >= F.col("need"))
             .withColumn("at", F.array_position("known", F.col("word")))
             # Only the first shared word of a pair counts, so that each pair is made once.
             .where(F.get(F.array_intersect("template_words", "known"), F.lit(0)) == F.col("word"))
             .where(F.least(F.size("template_words") - F.col("place"), F.size("known") - F.col("at") + 1) >= F.col("need")))
    shared = F.size(F.array_intersect("template_words", "known"))
    return (pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
            .select("doc_id", "text_hash", "block", "known", "many", "template", "label", "shared",
                    (F.col("shared") / F.size("template_words")).alias("containment")))


def base_places(words: Column) -> Column:
    """(start, label) of every place of a base phrase."""
    def here(phrase, label):
        parts = phrase.split()
        at = lambda i: F.forall(F.array(*[F.get(words, i + k) == p for k, p in enumerate(parts)]),
                                lambda ok: F.coalesce(ok, F.lit(False)))
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), at)
        return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))

    needed = F.array_contains(words, "license")
    return F.when(needed, F.concat(*[here(p, x) for p, x in PHRASES.items()]))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD,
         templates=TEMPLATES) -> DataFrame:
    """Per document: words, base places, labels and the best containment (1 for a base phrase)."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.withColumn("words", words_of(F.col("text")))
    found = matching_blocks(own, word_order(own, templates), threshold, templates)
    # A block matches at most every template once, also where rows repeat.
    matches = F.collect_set(F.struct("template", "label", "containment"))
    blocks = found.groupBy("doc_id", "text_hash", "block").agg(
        matches.alias("m"), F.map_from_arrays(F.first("known"), F.first("many")).alias("many"))
    by_name = lambda values: F.create_map(*[c for name, names in values.items()
                                            for c in (F.lit(name), F.array(*map(F.lit, names)).cast("array<string>"))])
    wider, words = by_name(wider_templates(templates)), by_name(_template_words(templates))
    need = F.create_map(*[c for name, ws in _template_words(templates).items()
                          for c in (F.lit(name), F.lit(math.ceil(threshold * len(ws) - 1e-9)))])
    many = lambda w: F.coalesce(F.try_element_at("many", w), F.lit(0))

    def hidden(x: Column) -> Column:
        """Whether a wider template of the block accounts for this one."""
        def within(y: Column) -> Column:
            often = F.array_max(F.transform(F.array_except(words[y["template"]], words[x["template"]]), many))
            beside = F.size(F.filter(words[x["template"]], lambda w: many(w) > often))
            return F.array_contains(wider[x["template"]], y["template"]) & (beside < need[x["template"]])

        return F.exists("m", within)

    labels = blocks.select("doc_id", "text_hash", F.inline(F.filter("m", lambda x: ~hidden(x))))
    # One row per id and text; partial sets are merged before the shuffle.
    found = (labels.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_best")))
    rows = own.select("doc_id", F.xxhash64("text").alias("text_hash"),
                      F.size("words").cast("long").alias("n_words"), base_places(F.col("words")).alias("places"))
    none = F.array().cast("array<string>")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    places = F.coalesce("places", F.array().cast("array<struct<start:int,label:string>>"))
    base = F.array_sort(F.array_distinct(places["label"]))
    starts = places["start"]
    return joined.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        base.alias("base"), F.array_sort(F.array_union(base, F.coalesce("_labels", none))).alias("all_labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))


def op6(docs: DataFrame) -> DataFrame:
    return scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join("all_labels", ",").alias("labels"), "score")


def op6_sql() -> str:
    """The same rows by DuckDB: every block against every template."""
    gap = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    wider = wider_templates(TEMPLATES)
    rows = ", ".join(f"('{n}', '{x}', {sorted(set(t.split()))}, {math.ceil(THRESHOLD * len(set(t.split())) - 1e-9)}, "
                     f"{wider[n]}::varchar[])" for n, x, t in TEMPLATES)
    phrases = " union all ".join(
        f"select k, i - 1 as start, '{label}' as label from pos where "
        + " and ".join(f"words[i + {j}] = '{w}'" for j, w in enumerate(p.split())) for p, label in PHRASES.items())
    size = block_words(TEMPLATES)
    step = size // 2
    return rf"""
with templates(template, label, tw, need, wider) as (values {rows}),
d as (select row_number() over () as k, doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') as t from documents),
w as (select k, doc_id, t, regexp_extract_all(t, '{gap}') as words from d),
pos as (select k, words, unnest(range(1, len(words) + 1)) as i from w),
base as ({phrases}),
b as (select k, count(*) as n, min(start) as lo, max(start) as hi, list_sort(list(distinct label)) as labels from base group by k),
lines as (select k, regexp_extract_all(unnest(string_split(t, chr(10))), '{gap}') as ws from d
          union all select k, words from w where contains(t, chr(10))),
blocks as (select k, row_number() over () as b, ws[s + 1 : s + {size}] as raw, list_distinct(ws[s + 1 : s + {size}]) as bw from (
           select k, ws, unnest(range(0, greatest(1, (ceil((len(ws) - {size}) / {step}) + 1) * {step})::bigint, {step})) as s
           from lines) x),
hit as (select k, b, raw, template, label, tw, need, wider, len(list_intersect(bw, tw)) / len(tw) as containment
        from blocks, templates where len(list_intersect(bw, tw)) >= need),
often as (select h.k, h.b, h.template, h.raw, h.tw, h.need,
                 list_max(list_transform(list_filter(y.tw, lambda w: not list_contains(h.tw, w)),
                                         lambda w: len(list_filter(h.raw, lambda z: z = w)))) as n
          from hit h join hit y on y.b = h.b and list_contains(h.wider, y.template)),
hidden as (select b, template from often
           where len(list_filter(tw, lambda w: len(list_filter(raw, lambda z: z = w)) > n)) < need),
m as (select k, list(distinct label) as labels, max(containment) as best from hit
      where not exists (select 1 from hidden x where x.b = hit.b and x.template = hit.template) group by k)
select w.doc_id, len(words)::bigint as n_words, coalesce(b.n, 0)::bigint as n_base, b.lo::bigint as first_word,
       b.hi::bigint as last_word, coalesce(array_to_string(b.labels, ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') as labels,
       case when b.n > 0 then 1.0::double else coalesce(m.best, 0.0)::double end as score
from w left join b on b.k = w.k left join m on m.k = w.k"""
