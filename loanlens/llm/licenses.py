"""License scan with ordered signature rules (DataFrame and SQL functions only).

Rules are regular expressions over the text's words (lower-cased A-Z, joined by single spaces).
Most texts never meet one: a document is looked at only if it holds a stem of some rule, and a rule
only if its keyword is among the document's words. Every detection is an interval of words with the
rule's priority. A detection inside another interval of at least its priority is suppressed (of
equal intervals the higher priority stays); what is left gives the labels. The three base phrases
are rules of the highest priority whose labels always stay.

Defined results: a NULL or empty text has no words and no labels (score 0); repeated rows and equal
doc_ids give a row each; texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Word characters of a text before lower-casing: 0-9, A-Z, a-z and everything from U+0080.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# families: label, full name, short name (words that identify it), keyword, versions
_FAMILIES = [
    ("gpl", "gnu general public licen[cs]e", "gpl", "gnu", ("1", "2", "3")),
    ("lgpl", "gnu (?:lesser|library) general public licen[cs]e", "lgpl", "gnu", ("2", "2 1", "3")),
    ("agpl", "gnu affero general public licen[cs]e", "agpl", "gnu", ("1", "3")),
    ("gfdl", "gnu free documentation licen[cs]e", "gfdl", "gnu", ("1 1", "1 2", "1 3")),
    ("apache", "apache (?:software )?licen[cs]e", "apache", "apache", ("1", "1 1", "2")),
    ("mpl", "mozilla public licen[cs]e", "mpl", "mozilla", ("1", "1 1", "2")),
    ("epl", "eclipse public licen[cs]e", "epl", "eclipse", ("1", "2")),
    ("cddl", "common development and distribution licen[cs]e", "cddl", "distribution", ("1", "1 1")),
    ("cpl", "common public licen[cs]e", "cpl", "common", ("1",)),
    ("eupl", "european union public licen[cs]e", "eupl", "european", ("1 1", "1 2")),
    ("osl", "open software licen[cs]e", "osl", "open", ("1", "2", "2 1", "3")),
    ("afl", "academic free licen[cs]e", "afl", "academic", ("1 1", "2", "2 1", "3")),
    ("artistic", "artistic licen[cs]e", "artistic", "artistic", ("1", "2")),
    ("bsl", "boost software licen[cs]e", "bsl", "boost", ("1",)),
    ("zpl", "zope public licen[cs]e", "zpl", "zope", ("2", "2 1")),
    ("lppl", "latex project public licen[cs]e", "lppl", "latex", ("1", "1 2", "1 3")),
    ("ofl", "sil open font licen[cs]e", "ofl", "font", ("1", "1 1")),
    ("cecill", "cecill free software licen[cs]e", "cecill", "cecill", ("1", "2", "2 1")),
    ("odbl", "open (?:data commons open )?database licen[cs]e", "odbl", "database", ("1",)),
]
_PLAIN = [
    ("mit", "mit licen[cs]e", "mit"), ("mit", "expat licen[cs]e", "expat"), ("isc", "isc licen[cs]e", "isc"),
    ("x11", "x11 licen[cs]e", "x11"), ("zlib", "zlib(?: libpng)? licen[cs]e", "zlib"),
    ("unlicense", "unlicen[cs]e(?: org)?", "unlicense"), ("wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "do what the fuck you want to public licen[cs]e", "fuck"), ("ncsa", "ncsa open source licen[cs]e", "ncsa"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd) licen[cs]e", "bsd"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e", "bsd"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd) licen[cs]e", "bsd"), ("bsd", "bsd(?: style)? licen[cs]e", "bsd"),
    ("postgresql", "postgresql licen[cs]e", "postgresql"), ("python", "python software foundation licen[cs]e", "python"),
    ("php", "php licen[cs]e", "php"), ("ruby", "ruby licen[cs]e", "ruby"), ("openssl", "openssl licen[cs]e", "openssl"),
    ("ms-pl", "microsoft public licen[cs]e", "microsoft"), ("ms-rl", "microsoft reciprocal licen[cs]e", "microsoft"),
    ("beerware", "beer ware licen[cs]e", "beer"), ("vim", "vim licen[cs]e", "vim"), ("curl", "curl licen[cs]e", "curl"),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0"), ("public-domain", "dedicated to the public domain", "domain"),
    ("public-domain", "public domain dedication", "domain"), ("proprietary", "all rights reserved", "reserved"),
    ("proprietary", "proprietary licen[cs]e", "proprietary"), ("proprietary", "licen[cs]ed commercially", "commercially"),
    ("permission-notice", "permission is hereby granted free of charge", "hereby"),
    ("redistribution-notice", "redistribution and use in source and binary forms", "redistribution"),
    ("warranty-notice", "without warranties or conditions of any kind", "warranties"),
    ("warranty-notice", "provided as is without warranty of any kind", "warranty"),
]
_GRANTS = ("licen[cs]ed under(?: the)?(?: terms of(?: the)?)?", "released under(?: the)?(?: terms of(?: the)?)?",
           "distributed under(?: the)?(?: terms of(?: the)?)?", "subject to(?: the)?(?: terms of(?: the)?)?")
_CC = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
_CC_LONG = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:atives|s)"}


#: Short names that name a license without the word; three letters and a number (``epl 2``) do not.
_BARE = ("gpl", "lgpl", "agpl", "gfdl", "apache", "cddl", "eupl", "lppl", "cecill", "odbl")


def rules() -> list[tuple[str, str, str, int, float, bool]]:
    """Ordered rules (label, regex, keyword, priority, weight, is_base).

    A grant with a version beats a versioned name, a versioned name a bare one, and a bare name a
    notice; written out for every family and version.
    """
    out = [(label, phrase, max(phrase.split(), key=len) if label != "cc-by-nc" else "cc", 4, 0.95, True)
           for phrase, label in BASE.items()]
    for label, name, short, key, versions in _FAMILIES:
        for v in versions:
            tag = f"{label}-{v.replace(' ', '.')}"
            number = f"(?:version |v ?)?{v}" + ("(?: 0)?" if " " not in v else "")
            later = "(?: (?:only|or(?: at your option)?(?: any)? later(?: version)?))?"
            for grant in _GRANTS:
                out.append((tag, f"{grant} {name} {number}{later}", key, 3, 0.9, False))
            out.append((tag, f"{name} {number}{later}", key, 2, 0.8, False))
            out.append((tag, f"spdx licen[cs]e identifier {short} {v}(?: 0)?{later}", "spdx", 3, 0.9, False))
            if short in _BARE:
                out.append((tag, f"{short} (?:v ?)?{v}(?: 0)?{later}", short, 2, 0.6, False))
        out.append((label, name, key, 1, 0.5, False))
    # a name that leaves out a word of the full one
    for v in ("1", "2", "3"):
        out.append((f"gpl-{v}", f"gnu general public licen[cs]e (?:version |v ?){v}(?: 0)?", "gnu", 2, 0.8, False))
        out.append((f"gpl-{v}", f"general public licen[cs]e (?:version |v ?){v}", "general", 2, 0.7, False))
    for kind in _CC:
        long = " ".join(_CC_LONG[x] for x in kind.split())
        tag = f"cc-{kind.replace(' ', '-')}"
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            out.append((f"{tag}-{v.replace(' ', '.')}", f"cc {kind} {v}", "cc", 3, 0.9, False))
            out.append((f"{tag}-{v.replace(' ', '.')}", f"creative commons {long}(?: licen[cs]e)? {v}(?: international)?",
                        "creative", 3, 0.9, False))
        out.append((tag, f"cc {kind}", "cc", 2, 0.7, False))
        out.append((tag, f"creative commons {long}", "creative", 2, 0.7, False))
    for label, name, key in _PLAIN:
        for grant in _GRANTS:
            if "licen" in name:
                out.append((label, f"{grant} {name}", key, 3, 0.9, False))
        out.append((label, name, key, 2 if "licen" in name else 1, 0.7 if "licen" in name else 0.4, False))
    return out


#: Any match of any rule needs one of these in the lower-cased text (checked by a test).
STEMS = ("licen", "cc", "creative", "spdx", "domain", "reserved", "hereby", "redistribution", "warrant", "wtfpl",
         *_BARE)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per document."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.expr(f"regexp_count(text, r'{_WORD}')").cast("long").alias("n_words"),
        F.lower("text").alias("low"))
    gate = F.lit(False)
    for stem in sorted(set(STEMS), key=lambda s: (len(s), s)):
        if not any(o != stem and o in stem for o in STEMS):
            gate = gate | F.contains("low", F.lit(stem))
    docs = docs.withColumn("gate", gate)
    none = docs.where("not gate").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_base"),
                                         F.lit(None).cast("long").alias("first_word"),
                                         F.lit(None).cast("long").alias("last_word"),
                                         F.lit("").alias("base_labels"), F.lit("").alias("labels"),
                                         F.lit(0.0).alias("score"))
    table = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(label).alias("label"),
                               F.lit(f"(?<= ){regex}(?= )").alias("re"), F.lit(key).alias("key"),
                               F.lit(prio).alias("prio"), F.lit(weight).alias("weight"), F.lit(base).alias("base"))
                      for i, (label, regex, key, prio, weight, base) in enumerate(rules())))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    near = docs.where("gate").select(
        "doc_id", "n_words", F.monotonically_increasing_id().alias("row"),
        F.concat(F.lit(" "), F.regexp_replace(F.translate("text", upper, upper.lower()), _GAP, " "),
                 F.lit(" ")).alias("norm"))
    near = near.withColumn("own", F.array_distinct(F.split("norm", " +")))
    near = near.select("doc_id", "n_words", "row", "norm", F.explode_outer(
        F.filter(table, lambda r: F.array_contains("own", r["key"]))).alias("r"))
    count = "regexp_count({}, r'[^ ]+')"
    near = near.select("doc_id", "n_words", "row", "r", F.expr("regexp_extract_all(norm, r.re, 0)").alias("m"),
                       F.expr("split(norm, r.re, -1)").alias("p"))
    near = near.select("doc_id", "n_words", "row", "r", F.posexplode_outer(F.expr(
        f"zip_with(m, slice(p, 1, size(m)), (x, y) -> struct({count.format('x')} as own, {count.format('y')} as gap))"
    )).alias("j", "s"))
    upto = Window.partitionBy("row", "r.i").orderBy("j")
    spans = near.select(
        "doc_id", "n_words", "row", "j", "r.label", "r.prio", "r.weight", "r.base", "s.own",
        (F.sum(F.col("s.gap") + F.col("s.own")).over(upto) - F.col("s.own")).alias("start"))
    spans = spans.withColumn("end", F.col("start") + F.col("own"))
    before = (Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("prio"), "label")
              .rowsBetween(Window.unboundedPreceding, -1))
    covered = F.lit(False)
    for level in (4, 3, 2, 1):
        reach = F.max(F.when(F.col("prio") >= level, F.col("end"))).over(before)
        covered = covered | ((F.col("prio") == level) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    spans = spans.withColumn("stays", F.col("start").isNotNull() & (F.col("base") | ~covered))
    base = F.col("stays") & F.col("base")
    found = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("stays"), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("stays"), F.col("weight"))), F.lit(0.0)).alias("score"))
    return none.unionByName(found.select(none.columns))
