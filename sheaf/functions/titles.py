"""What kind of standard a title names, and whether the title fits the kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds by falling priority, the words that show each, and words
#: that rule the first one out.
KINDS = (
    ("方法标准", "试验方法|测定方法|测试方法|校准方法|计算方法|测量方法|检验方法|试验规范|性能试验|试验规程|测试法|试验确定|检定规程"),
    ("术语标准", "术语|词汇|定义"),
    ("分类标准", "分类|编码|代号|命名方法|型号命名|型号编制"),
    ("规程标准", "规程"),
    ("指南标准", "指南|导则"),
    ("安全标准", "安全"),
    ("产品标准", "通用技术条件|通用技术规范|技术条件|技术规范|总规范|通用规范|规范|通则|总则|限值|分级|基本技术要求|安全技术要求|要求"),
)
NO_METHOD = "指南|导则"
OTHER = "其他标准"
#: Words that a title of each kind should have.
EXPECTED = {
    "方法标准": "试验|测定|测试|校准|计算|测量|检验",
    "术语标准": "术语|定义|词汇",
    "分类标准": "分类|编码|命名|型号",
    "规程标准": "规程",
    "指南标准": "指南|导则",
    "安全标准": "安全",
    "产品标准": "条件|规范|通则|总则|要求|限值|分级",
}
#: Endings of a word before 用 that make it no place of use.
NO_USE = "[通作应使采利运]$"


def kind_of(title: Column) -> Column:
    """(kind, basis): the first kind whose words the title has, and the word found."""
    out = F.struct(F.lit(OTHER).alias("kind"), F.lit("").alias("basis"))
    for kind, words in reversed(KINDS):
        found = F.regexp_extract(title, words, 0)
        fits = found != "" if kind != KINDS[0][0] else (found != "") & ~title.rlike(NO_METHOD)
        out = F.when(fits, F.struct(F.lit(kind).alias("kind"), found.alias("basis"))).otherwise(out)
    return out


def fits_kind(title: Column, kind: Column) -> Column:
    """Whether a title has a word that its kind asks for; other kinds ask for none."""
    words = F.element_at(F.create_map(*(F.lit(v) for kv in EXPECTED.items() for v in kv)), kind)
    return F.coalesce(F.regexp_like(title, words), F.lit(True))


def place_of_use(title: Column) -> Column:
    """The X用 of a title, null where what precedes 用 is part of another word."""
    every = F.transform(F.regexp_extract_all(title, F.lit("([一-龥]+)用"), F.lit(1)), lambda c: F.regexp_replace(F.regexp_replace(c, "专$", ""), "^(?:系列|型号)|^.*式", ""))
    good = F.filter(every, lambda c: (c != "") & ~c.rlike(NO_USE) & ~c.contains("的"))
    return F.when(F.size(good) > 0, F.concat(F.regexp_replace(good[0], "^.*[和与、](?=.{1,6}$)", ""), F.lit("用")))


def subjects(titles: DataFrame, lexicon: DataFrame, key: str, title: str = "title", word: str = "word") -> DataFrame:
    """key and the longest lexicon word in its title, the rest of the title beside it.

    Each title is looked up once, however many keys have it. Titles meet words
    through their substrings' first two characters, an equi-join on a small key,
    so the lexicon may be of any size.
    """
    own = titles.select(key, F.col(title).alias("_t"))
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length("_t"), F.lit(1))), lambda n: F.substring("_t", n, 2))
    words = lexicon.select(F.col(word).alias("_w")).distinct()
    starts = own.select("_t").distinct().select("_t", F.explode(F.array_distinct(F.concat(pairs, F.split("_t", "")))).alias("_k"))
    met = starts.join(words.withColumn("_k", F.substring("_w", 1, 2)), "_k").filter(F.col("_t").contains(F.col("_w")))
    best = met.groupBy("_t").agg(F.min_by("_w", F.struct(-F.length("_w"), "_w")).alias("subject"))
    return own.join(best, "_t", "left").select(key, "subject", F.expr("replace(_t, subject, '')").alias("remainder"))
