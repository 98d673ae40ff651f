"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    bag_search,
    ball_tree,
    bpe,
    decontaminate,
    jaccard_join,
    language,
    licenses,
    main_text,
    quality,
    spelling,
    token_files,
    token_histogram,
    url_rules,
)
from tidegauge.llm.arrow import table
from tidegauge.session import configure, shared_dir

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Fixed value: the id behind each document of the token files.
END_ID = 2
#: What is a word of the spelling query, its least length, count and times as often.
WORD = "[A-Za-z\u00C0-\u00FF]+"
LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10

URL_RULES = (
    url_rules.Rule("block", "net"),
    url_rules.Rule("allow", "example.net", "/en/"),
    url_rules.Rule("block", "example.com", "/de/"),
    url_rules.Rule("allow", "org", "/fr/"),
)


def fold(id_column: str, folds: int) -> Column:
    """The remainder of the CRC-32 of an id's text."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def held_out(folds: int, number: int) -> Column:
    """Whether a document's remainder is the one kept from learning; false without an id."""
    return F.coalesce(fold("doc_id", folds) == number, F.lit(False)).alias("held_out")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode_texts(docs, bpe.read_ranks(spark, RANKS), PATTERN)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    texts = main_text.extract_main_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold."""
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, fold("doc_id", 3) != 1)
    found = language.identify(docs, model)
    return found.select("doc_id", held_out(3, 1), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    found = quality.score(docs, model)
    return found.select("doc_id", held_out(5, 0), "score", "predicted")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, quantiles and truncated totals for every context limit."""
    docs = table(spark, sf_dir, "documents")
    lengths = token_histogram.encoded_lengths(docs, bpe.read_ranks(spark, RANKS), PATTERN)
    return token_histogram.length_histogram(lengths)


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, tags and notices of every document."""
    found = licenses.scan_licences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("place_labels")), ",").alias("base_labels"),
        F.array_join(F.array_sort("labels"), ",").alias("labels"),
        "score",
    )


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict for every page's URL."""
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every query vector."""
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent spelling."""
    docs = table(spark, sf_dir, "documents")
    words = spelling.count_words(docs, WORD, LEAST_LETTERS, spelling.crc_typo(31))
    return spelling.spelling_variants(words.where(F.col("n") >= LEAST_COUNT), TIMES)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from files of token ids."""
    with open(TOKENIZER, encoding="utf-8") as file:
        tokenizer = file.read()
    path = shared_dir(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, tokenizer, path, END_ID)
    found = token_files.read_token_files(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return bag_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from documents to token ids."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


Query = Callable[[SparkSession, str], DataFrame]


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {
    q.__name__: _configured(q)
    for q in (
        op1_byte_bpe, op2_main_text, op3_benchmark_leaks, op4_jaccard_join, op5_language,
        op6_quality, op7_token_counts, op8_licences, op9_url_rules, op10_top_k, op11_spelling_variants,
        op12_token_files, op13_ranked_search, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op9_url_rules": r"""
with parts as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
split as (
  select page_id,
    translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
  from parts),
rules(verdict, rule_host, rule_path) as (values
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
judged as (
  select page_id, host, path,
    (select max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path,
                            verdict := rules.verdict))
     from rules
     where (host = rule_host or ends_with(host, '.' || rule_host))
       and starts_with(path, rule_path)) as best
  from split)
select page_id, host, path, best.rule as rule,
  case when best.rule is not null then best.verdict when host = '' then 'block' else 'allow' end as verdict
from judged""",
    "op10_top_k": """
with vectors as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as query_id, a.q, b.vec_id,
    cast(coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])), 0) as bigint) as score
  from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
  where a.vec_id % 50 = 0),
ranked as (
  select query_id, vec_id, score,
    cast(row_number() over (partition by query_id, q order by score desc, vec_id) as integer) as rank
  from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op11_spelling_variants": r"""
with recursive steps(byte, crc, bit) as (
  select range::bigint, range::bigint, 0 from range(256)
  union all
  select byte, case when crc % 2 = 1 then xor(crc // 2, 3988292384) else crc // 2 end, bit + 1
  from steps where bit < 8),
crc_table as (select list(crc order by byte) as entries from steps where bit = 8),
runs as (
  select doc_id, run, count(*) as times from (
    select doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{C0}-\x{FF}]+')) as run
    from documents)
  where length(run) >= 7 group by doc_id, run),
coded as (
  select run, times, hex(encode(doc_id || ':' || run)) as digits from runs),
hashed as (
  select run, times, xor(list_reduce(
      list_transform(range(1, length(digits), 2), lambda i:
        (instr('0123456789ABCDEF', digits[i]) - 1) * 16 + instr('0123456789ABCDEF', digits[i + 1]) - 1),
      lambda crc, b: xor(crc // 256, entries[xor(crc % 256, b) + 1]), 4294967295::bigint),
    4294967295::bigint) as h
  from coded, crc_table),
words as (
  select word, sum(times)::bigint as n from (
    select times, case when h % 31 = 0
      then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
    from hashed)
  where length(word) >= 7 group by word having sum(times) >= 2),
masked as (
  select word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as place from words)),
near as (
  select a.word, b.word as other, b.n as other_n
  from masked a join masked b using (place, rest) where a.word <> b.word and length(a.word) = length(b.word)
  union
  select m.word, w.word, w.n from masked m join words w on m.rest = w.word
  union
  select w.word, m.word, m.n from masked m join words w on m.rest = w.word),
best as (
  select word, count(*) as n_near, max(other_n) as most from near group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when most >= 10 * w.n then
      (select min(other) from near x where x.word = w.word and x.other_n = most) end as form,
    case when most >= 10 * w.n then most end as form_n
  from words w left join best using (word)),
chains(word, root, depth) as (
  select word, word, 0 from forms
  union all
  select c.word, f.form, depth + 1 from chains c join forms f on f.word = c.root where f.form is not null)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n
from forms f join (select word, arg_max(root, depth) as root from chains group by word) c using (word)""",
    "op13_ranked_search": r"""
with doc_terms as (
  select rowid as doc, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as rowid, doc_id, text from documents)),
item_terms as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
lengths as (select doc, any_value(doc_id) as doc_id, count(*) as n from doc_terms group by doc),
totals as (select count(*)::bigint as docs, sum(n)::bigint as words from lengths),
norms as (
  select doc, doc_id, 10 + (90 * n * docs) // words as m from lengths, totals),
counts as (
  select doc, term, count(*) as tf from doc_terms
  where term in (select term from item_terms) group by doc, term),
weights as (
  select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from counts, totals group by term, docs),
scored as (
  select item_id, doc_id, doc, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from item_terms join counts using (term) join weights using (term) join norms using (doc)
  group by item_id, doc_id, doc),
ranked as (
  select item_id, doc_id, score, cast(row_number() over (
    partition by item_id order by score desc, doc_id nulls last) as integer) as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10""",
}
