"""Named entities: a recogniser's spans become tags, with ids where asked for, and dates lose their numbers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrow import frame_pieces, lists
from ..schemas import TOKEN

ARROW_TOKEN = pa.list_(pa.struct([("word", pa.string()), ("ner", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

# The classes that may be replaced.
CLASSES = ("GPE", "PERSON", "ORG", "NORP", "LOC", "FAC", "PRODUCT", "WORK_OF_ART", "EVENT", "LAW")

#: From texts to their tokens (word, class, start, end).
Recogniser = Callable[[list[str]], list[list[tuple[str, str, int, int]]]]


@dataclass(frozen=True)
class Tag:
    tag: str
    need_id: bool = False


def tag_config(plain: dict[str, str] | None = None, with_id: dict[str, str] | None = None) -> dict[str, Tag]:
    """Tags by class. A class has one of both kinds; classes that share a tag share its kind."""
    plain, with_id = plain or {}, with_id or {}
    if both := set(plain) & set(with_id):
        raise ValueError(f"with and without id: {sorted(both)}")
    config = {c: Tag(t) for c, t in plain.items()} | {c: Tag(t, True) for c, t in with_id.items()}
    if unknown := set(config) - set(CLASSES):
        raise ValueError(f"unknown classes: {sorted(unknown)}")
    kinds: dict[str, bool] = {}
    for x in config.values():
        if kinds.setdefault(x.tag, x.need_id) != x.need_id:
            raise ValueError(f"tag {x.tag} both with and without id")
    return config


def dictionary_recogniser(words: dict[str, str], dates: bool = True) -> Recogniser:
    """Finds listed words, longest first, and dates; stands in for a model."""
    listed = sorted(words, key=len, reverse=True)
    date = r"(?:\d+年)?\d+月\d+日"
    pattern = re.compile("|".join([*([date] if dates else []), *map(re.escape, listed)]) or r"(?!)")
    return lambda texts: [[(m.group(), words.get(m.group(), "DATE"), m.start(), m.end()) for m in pattern.finditer(t or "")] for t in texts]


def recognise(df: DataFrame, recogniser: Recogniser, batch_size: int = 8) -> DataFrame:
    """title_tokens and article_tokens by a recogniser that is set up once for each task, both in one Python process; texts
    and tokens of a batch are Python objects a piece at a time."""

    texts, out = ("title", "article"), ("title_tokens", "article_tokens")

    def found(column: pa.Array) -> Iterator[list[dict]]:
        own = column.to_pylist()
        for at in range(0, len(own), batch_size):
            for tokens in recogniser(own[at : at + batch_size]):
                yield [{"word": w, "ner": c, "start": a, "end": b} for w, c, a, b in tokens]

    @F.arrow_udf(T.StructType([T.StructField(c, TOKEN) for c in out]))
    def tokens(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for whole in batches:
            for batch in frame_pieces(pa.RecordBatch.from_arrays(list(whole), names=list(texts)), texts, step=batch_size):
                yield pa.StructArray.from_arrays([lists(found(c), ARROW_TOKEN) for c in batch.columns], names=list(out))

    both = f"tokens_{uuid.uuid4().hex}"
    rows = df.withColumn(both, tokens.asNondeterministic()(*texts))
    return rows.withColumns({c: F.col(both)[c] for c in out}).drop(both)


def replace_spans(title: str, article: str, title_tokens: list, article_tokens: list, config: dict[str, Tag]) -> tuple[str, str]:
    """One record's texts with tags for tokens, as ``replace_entities`` gives them. Ids count from 0 for each tag, title first, the same word has the same id."""
    ids: dict[tuple[str, str], int] = {}
    next_id: dict[str, int] = {}
    out = []
    for text, tokens in ((title, title_tokens), (article, article_tokens)):
        parts, done = [], 0
        for t in sorted(tokens, key=lambda t: t["start"]):
            tag = config.get(t["ner"])
            if tag is None:
                continue
            shown = f"<{tag.tag}>"
            if tag.need_id:
                key = (t["word"], tag.tag)
                if key not in ids:
                    ids[key] = next_id.get(tag.tag, 0)
                    next_id[tag.tag] = ids[key] + 1
                shown = f"<{tag.tag}{ids[key]}>"
            parts += [text[done : t["start"]], shown]
            done = t["end"]
        out.append("".join([*parts, text[done:]]))
    return out[0], out[1]


def date_mask(word: str) -> str | None:
    if re.match(".*?年.*?月.*?日", word):
        return "<num>年<num>月<num>日"
    return "<num>月<num>日" if re.match(".*?月.*?日", word) else None


def _date_mask(word: Column) -> Column:
    """``date_mask`` of a column."""
    return F.when(word.rlike("(?d)^.*?年.*?月.*?日"), "<num>年<num>月<num>日").when(word.rlike("(?d)^.*?月.*?日"), "<num>月<num>日")


def _tagged(tokens: Column, config: dict[str, Tag]) -> Column:
    """Tokens with a tag, by their start; of equal starts in their order."""
    by_name = F.create_map(*[F.lit(v) for name, own in config.items() for v in (name, own.tag)])
    made = F.transform(
        F.coalesce(tokens, F.array().cast(TOKEN)),
        lambda t, i: F.struct(t["start"].alias("start"), i.alias("nth"), t["end"].alias("end"), F.coalesce(t["word"], F.lit("\0")).alias("word"), F.element_at(by_name, t["ner"]).alias("tag")),
    )
    return F.array_sort(F.filter(made, lambda t: t["tag"].isNotNull() & t["start"].isNotNull() & t["end"].isNotNull()))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shown(chars: Column, tokens: Column, ids: Column, numbers: dict[str, str]) -> Column:
    """A text with tags for tokens: what stands between each and the one before it, and its tag. ``chars`` are the text's
    characters: a slice of them takes as long as it is, whereas a substring looks for its place from the text's beginning."""
    ends = F.transform(tokens, lambda t: t["end"])
    each = F.arrays_zip(tokens.alias("t"), F.concat(F.array(F.lit(0)), ends).alias("done"))

    def piece(x: Column) -> Column:
        t, number = x["t"], F.lit("")
        for tag, place in numbers.items():
            number = F.when(t["tag"] == tag, (F.array_position(ids[place], t["word"]) - 1).cast("string")).otherwise(number)
        between = F.array_join(F.slice(chars, x["done"] + 1, F.greatest(F.coalesce(t["start"] - x["done"], F.size(chars)), F.lit(0))), "")
        return F.when(t.isNull(), between).otherwise(F.concat(between, F.lit("<"), t["tag"], number, F.lit(">")))

    return F.array_join(F.transform(each, piece), "")


def _showing(tokens: Column, ids: Column, numbers: dict[str, str]) -> Callable[[Column], Column]:
    return lambda chars: _shown(chars, tokens, ids, numbers)


def replace_entities(df: DataFrame, config: dict[str, Tag], dates: bool = False) -> DataFrame:
    """Title and article with tags, and with masked dates where asked for; the tokens go. No Python worker takes part.

    Ids count from 0 for each tag, in order of first appearance, the title's tokens first; the same word has the same id. Where
    tokens overlap, text between them that is negative in length is empty. After that each DATE token's word is
    replaced by its mask wherever it stands in either text. Null texts are empty; null token lists, and tokens without a
    tag, a start or an end, change nothing; a null word is a word of its own.
    """
    old = [c for c in df.columns if c not in ("title_tokens", "article_tokens")]
    named = df.select("*", *(F.coalesce(c, F.lit("")).alias(f"_{c}") for c in ("title", "article")))
    if config:
        counted = sorted({t.tag for t in config.values() if t.need_id})
        numbers = {tag: f"w{i}" for i, tag in enumerate(counted)}

        def with_ids(tags: Column) -> Column:
            every = F.concat(tags["title"], tags["article"])
            of_tag = lambda tag: F.array_distinct(F.transform(F.filter(every, lambda t: t["tag"] == tag), lambda t: t["word"]))
            ids = F.struct(F.lit(0).alias("none"), *(of_tag(tag).alias(numbers[tag]) for tag in counted))
            return _let(ids, lambda words: F.struct(*(_let(F.split(F.col(f"_{c}"), ""), _showing(tags[c], words, numbers)).alias(c) for c in ("title", "article"))))

        tags = F.struct(*(_tagged(F.col(f"{c}_tokens"), config).alias(c) for c in ("title", "article")))
        named = named.withColumn("_new", _let(tags, with_ids))
        named = named.select(*df.columns, *(F.col(f"_new.{c}").alias(f"_{c}") for c in ("title", "article")))
    if dates:
        empty = F.array().cast(TOKEN)
        every = F.concat(F.coalesce("title_tokens", empty), F.coalesce("article_tokens", empty))
        found = F.filter(every, lambda t: (t["ner"] == "DATE") & _date_mask(t["word"]).isNotNull())
        both = F.struct(F.col("_title").alias("title"), F.col("_article").alias("article"))
        fold = lambda s, t: F.struct(*(F.replace(s[c], t["word"], _date_mask(t["word"])).alias(c) for c in ("title", "article")))
        named = named.select("*", F.aggregate(found, both, fold).alias("_both")).withColumn("_title", F.col("_both.title")).withColumn("_article", F.col("_both.article"))
    return named.select(*(F.col(f"_{c}").alias(c) if c in ("title", "article") else F.col(c) for c in old))
