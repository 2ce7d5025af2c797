"""License detection by ordered signature rules, in DataFrame functions only.

A text becomes its words joined by single blanks. Every rule is a regex over
such words with a keyword that must be present; a text runs only the regexes
whose keyword it holds, and most texts hold none. Each match is an interval of
words. Overlaps are resolved by priority and containment: a detection inside
the interval of one with the same or a better priority is suppressed.

Priorities: 1 identifier tag, 2 grant ("licensed under ..."), 3 sentence of the
license text, 4 name with version, 5 name alone. No rule has an unbounded
repetition, so a match is at most ``LONGEST`` characters long.

Defined cases: null, empty and wordless texts have no words, no detections,
empty labels and score 0; repeated rows each get their own row; extra columns
with any name are left out of the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# (label, keyword, identifier words, name, versions): the text of each family
# as regexes over lower-case words. `{v}` in an identifier is a version.
FAMILIES = [
    ("gpl", "general public", "gpl {v}", "gnu general public licen[cs]e", ["1", "2", "3"]),
    ("gpl", "gpl", "gpl {v} 0", "gnu gpl", ["1", "2", "3"]),
    ("lgpl", "lesser", "lgpl {v}", "gnu lesser general public licen[cs]e", ["2 1", "3"]),
    ("lgpl", "library general", "lgpl {v} 0", "gnu library general public licen[cs]e", ["2"]),
    ("agpl", "affero", "agpl {v} 0", "gnu affero general public licen[cs]e", ["1", "3"]),
    ("gfdl", "free documentation", "gfdl {v}", "gnu free documentation licen[cs]e", ["1 1", "1 2", "1 3"]),
    ("apache", "apache", "apache {v}", "apache(?: software)? licen[cs]e", ["1 0", "1 1", "2 0"]),
    ("mit", "mit", "mit", "(?:the )?mit licen[cs]e", []),
    ("mit-0", "no attribution", "mit 0", "mit no attribution", []),
    ("x11", "x11", "x11", "(?:the )?x11 licen[cs]e", []),
    ("expat", "expat", "expat", "(?:the )?expat licen[cs]e", []),
    ("bsd", "bsd", "bsd {v} clause", "(?:the )?bsd licen[cs]e", ["1", "2", "3", "4"]),
    ("bsd-2-clause", "simplified bsd", "bsd 2 clause", "simplified bsd licen[cs]e", []),
    ("bsd-2-clause-freebsd", "freebsd", "bsd 2 clause freebsd", "freebsd licen[cs]e", []),
    ("bsd-3-clause", "new bsd", "bsd 3 clause", "new bsd licen[cs]e", []),
    ("bsd-4-clause", "original bsd", "bsd 4 clause", "original bsd licen[cs]e", []),
    ("0bsd", "zero clause", "0bsd", "zero clause bsd(?: licen[cs]e)?", []),
    ("isc", "isc", "isc", "(?:the )?isc licen[cs]e", []),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)? licen[cs]e", []),
    ("libpng", "libpng", "libpng {v}", "libpng licen[cs]e", ["2 0"]),
    ("boost", "boost", "bsl {v}", "boost software licen[cs]e", ["1 0"]),
    ("mpl", "mozilla", "mpl {v}", "mozilla public licen[cs]e", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", "epl {v}", "eclipse public licen[cs]e", ["1 0", "2 0"]),
    ("edl", "eclipse distribution", "edl {v}", "eclipse distribution licen[cs]e", ["1 0"]),
    ("cddl", "common development", "cddl {v}", "common development and distribution licen[cs]e", ["1 0", "1 1"]),
    ("cpl", "common public", "cpl {v}", "common public licen[cs]e", ["1 0"]),
    ("ipl", "ibm public", "ipl {v}", "ibm public licen[cs]e", ["1 0"]),
    ("ms-pl", "microsoft public", "ms pl", "microsoft public licen[cs]e", []),
    ("ms-rl", "microsoft reciprocal", "ms rl", "microsoft reciprocal licen[cs]e", []),
    ("artistic", "artistic", "artistic {v}", "artistic licen[cs]e", ["1 0", "2 0"]),
    ("wtfpl", "do what the", "wtfpl", "do what the fuck you want to public licen[cs]e", []),
    ("unlicense", "unlicense", "unlicense", "(?:the )?unlicense", []),
    ("cc0", "cc0", "cc0 {v}", "cc0(?: universal)?", ["1 0"]),
    ("cc-by", "cc by", "cc by {v}", "cc by", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "cc by sa", "cc by sa {v}", "cc by sa", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "cc by nc", "cc by nc {v}", "cc by nc", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "cc by nd", "cc by nd {v}", "cc by nd", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa {v}", "cc by nc sa", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd {v}", "cc by nc nd", ["2 0", "3 0", "4 0"]),
    ("cc-by", "commons attribution", "cc by {v} int", "creative commons attribution(?: international)?(?: licen[cs]e)?", ["3 0", "4 0"]),
    ("cc-by-sa", "sharealike", "cc by sa {v} int", "creative commons attribution sharealike(?: international)?(?: licen[cs]e)?", ["3 0", "4 0"]),
    ("cc-by-nc", "noncommercial", "cc by nc {v} int", "creative commons attribution noncommercial(?: international)?(?: licen[cs]e)?", ["3 0", "4 0"]),
    ("odbl", "open database", "odbl {v}", "open(?: data commons)? database licen[cs]e", ["1 0"]),
    ("odc-by", "data commons attribution", "odc by {v}", "open data commons attribution licen[cs]e", ["1 0"]),
    ("ofl", "open font", "ofl {v}", "(?:sil )?open font licen[cs]e", ["1 0", "1 1"]),
    ("psf", "python software", "psf {v}", "python software foundation licen[cs]e", ["2 0"]),
    ("php", "php", "php {v}", "php licen[cs]e", ["3 0", "3 01"]),
    ("ruby", "ruby", "ruby", "ruby licen[cs]e", []),
    ("openssl", "openssl", "openssl", "openssl licen[cs]e", []),
    ("eupl", "european union", "eupl {v}", "european union public licen[cs]e", ["1 1", "1 2"]),
    ("osl", "open software", "osl {v}", "open software licen[cs]e", ["2 1", "3 0"]),
    ("afl", "academic free", "afl {v}", "academic free licen[cs]e", ["2 1", "3 0"]),
    ("upl", "universal permissive", "upl {v}", "universal permissive licen[cs]e", ["1 0"]),
    ("ncsa", "illinois", "ncsa", "university of illinois(?: ncsa)? open source licen[cs]e", []),
    ("postgresql", "postgresql", "postgresql", "postgresql licen[cs]e", []),
    ("w3c", "w3c", "w3c", "w3c software(?: notice and)? licen[cs]e", []),
    ("vim", "vim", "vim", "vim licen[cs]e", []),
    ("beerware", "beer", "beerware", "beer ?ware licen[cs]e", []),
    ("proprietary", "rights reserved", "proprietary", "all rights reserved", []),
    ("public-domain", "public domain", "public domain", "(?:dedicated to|released into|in) the public domain", []),
]

# (label, keyword, sentence): sentences that license texts share with nothing else.
SENTENCES = [
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "noninfringement", "fitness for a particular purpose and noninfringement"),
    ("isc", "any purpose", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name", "neither the name of [^ ]{1,40}(?: [^ ]{1,40}){0,6} nor the names of its contributors"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software"),
    ("apache", "compliance with", "you may not use this file except in compliance with the license"),
    ("apache", "as is", "distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify"),
    ("gpl", "any later", "either version [0-9] of the license or (?:at your option )?any later version"),
    ("lgpl", "free software", "this library is free software you can redistribute it and or modify"),
    ("agpl", "remote network", "remote network interaction use with the gnu general public license"),
    ("mpl", "subject to the terms", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms"),
    ("zlib", "express or implied", "this software is provided as is without any express or implied warranty"),
    ("boost", "software license", "distributed under the boost software license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just", "you just do what the fuck you want to"),
    ("cc0", "copyright and related", "waived all copyright and related or neighboring rights"),
    ("ofl", "font software", "this font software is licensed under the sil open font license"),
]

# Every text that a rule or a base phrase matches holds one of these.
STEMS = ["licen", "gpl", " cc by ", " cc0 ", "creative commons", "no attribution", "zero clause", "rights reserved",
         "public domain", "is hereby granted", "noninfringement", "for any purpose", "redistribution and use",
         "neither the name", "advertising materials", "an as is basis", "free software", "accompanying materials",
         "express or implied", "free and unencumbered", "just do what", "all copyright and related"]

WEIGHT = {1: 1.0, 2: 0.9, 3: 0.8, 4: 0.7, 5: 0.5}
BASE_WEIGHT = 0.6
LONGEST = 400


def rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, regex), built from the families: tag, grant,
    name with each version, name, abbreviations; then the sentences."""
    out = []
    for label, key, tag, name, versions in FAMILIES:
        for v in versions or [""]:
            named = f"{label}-{v.replace(' ', '.')}" if v else label
            version = f"(?: or| and)?(?: version)? v?{v}" if v else ""
            ident = tag.replace("{v}", v)
            out.append((1, named, ident, f"spdx licen[cs]e identifier {ident}(?: only| or later)?"))
            out.append((2, named, key, f"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?"
                                       f"(?:terms of )?(?:the )?{name}{version}"))
            if v:
                out.append((4, named, key, f"{name}{version}"))
        out.append((2, label, key, "(?:licen[cs]ed|released|distributed|available|published) under (?:the )?"
                                   f"(?:terms of )?(?:the )?{name}"))
        out.append((5, label, key, name))
    out += [(3, label, key, sentence) for label, key, sentence in SENTENCES]
    return list(dict.fromkeys(out))


def _lower_ascii(text: Column) -> Column:
    """A-Z only; the full `lower` would also change other letters."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, lower))


def word_line(text: Column) -> Column:
    """" w1 w2 ... wn ", a single blank if there are no words."""
    line = F.regexp_replace(_lower_ascii(F.coalesce(text, F.lit(""))),
                            r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(line), F.when(F.trim(line) != "", F.lit(" ")).otherwise(F.lit("")))


def _blanks(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def places(line: Column, regex: Column) -> Column:
    """array<struct<chars, words>>: where matches start (overlaps included)."""
    parts = F.split(line, F.concat(F.lit("(?<= )(?=(?:"), regex, F.lit(") )")))
    none = F.array().cast("array<struct<chars:int,words:int>>")
    walk = F.aggregate(
        parts, F.struct(none.alias("at"), F.lit(0).alias("chars"), F.lit(-1).alias("words")),
        lambda s, p: F.struct(
            F.array_append(s["at"], F.struct(s["chars"].alias("chars"), s["words"].alias("words"))).alias("at"),
            (s["chars"] + F.char_length(p)).alias("chars"), (s["words"] + _blanks(p)).alias("words")),
        lambda s: s["at"])
    return F.slice(walk, 2, F.size(parts))


def padded(key: str) -> str:
    """A keyword as looked for: short ones as whole words, others as prefixes."""
    return f" {key} " if len(key) < 4 else f" {key}"


def gate_keys() -> list[str]:
    """The padded keywords of rules and base phrases; one that holds another
    needs no look of its own. A short one that ends words of others ("lgpl") is
    looked for anywhere: the gate may let more texts through, never fewer."""
    every = {padded(key) for _, _, key, _ in rules()} | {padded(p) for p in BASE}
    short = {k.strip() for k in every if k.endswith(" ")}
    ends = {k for k in short if any(k in o and padded(k) not in f"{o} " for o in every)}
    keys = sorted(every | ends, key=lambda k: (len(k), k))
    return [k for i, k in enumerate(keys) if not any(o in k for o in keys[:i])]


def _rule_table() -> Column:
    """The rules by keyword, so that each keyword is looked for once."""
    by_key: dict[str, list[Column]] = {}
    for p, label, key, regex in rules():
        by_key.setdefault(padded(key), []).append(F.struct(
            F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(regex).alias("regex")))
    return F.array(*[F.struct(F.lit(key).alias("key"), F.array(*own).alias("rules")) for key, own in by_key.items()])


def detections(line: Column) -> Column:
    """Sorted array of (start, minus end, priority, label) of all rules."""
    def found(rule):
        def one(at):
            match = F.regexp_substr(F.substr(line, at["chars"] + 1, F.lit(LONGEST)),
                                    F.concat(F.lit("^(?:"), rule["regex"], F.lit(")(?= )")))
            return F.struct(at["words"].alias("start"), (-(at["words"] + _blanks(match))).alias("till"),
                            rule["priority"].alias("priority"), rule["label"].alias("label"))
        return F.transform(places(line, rule["regex"]), one)

    present = F.flatten(F.transform(F.filter(F.col("_rules"), lambda r: F.contains(line, r["key"])),
                                    lambda r: r["rules"]))
    return F.array_sort(F.flatten(F.transform(present, found)))


def unsuppressed(found: Column) -> Column:
    """Detections not inside one of the same or a better priority. In the
    order (start, longest, priority) whatever holds a detection stands before
    it, so the furthest end per priority so far decides."""
    kind = "array<struct<start:int,till:int,priority:int,label:string>>"
    levels = sorted(WEIGHT)
    start = F.struct(F.array().cast(kind).alias("kept"), *[F.lit(-1).alias(f"end{p}") for p in levels])

    def step(s, d):
        inside = F.lit(False)
        for p in levels:
            inside = inside | ((d["priority"] >= p) & (s[f"end{p}"] >= -d["till"]))
        return F.struct(
            F.when(inside, s["kept"]).otherwise(F.array_append(s["kept"], d)).alias("kept"),
            *[F.when(d["priority"] == p, F.greatest(s[f"end{p}"], -d["till"])).otherwise(s[f"end{p}"]).alias(f"end{p}")
              for p in levels])

    return F.aggregate(found, start, step, lambda s: s["kept"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, base (array of base places: start,
    label) and found (array of unsuppressed detections: start, till, priority,
    label; till is minus the last word)."""
    lines = docs.select(F.col(id_col), word_line(F.col(text_col)).alias("_line"))
    line = F.col("_line")
    stem, gate = F.lit(False), F.lit(False)
    for k in STEMS:
        stem = stem | F.contains(line, F.lit(k))
    for k in gate_keys():
        gate = gate | F.contains(line, F.lit(k))
    gate = stem & gate  # most texts hold no stem, and nothing else is looked for in them
    alternatives = "|".join(BASE)

    def base(at):
        named = F.lit(None).cast("string")
        ahead = F.substr(line, at["chars"] + 1, F.lit(LONGEST))
        for phrase, name in BASE.items():
            named = F.when(F.startswith(ahead, F.lit(phrase + " ")), F.lit(name)).otherwise(named)
        return F.struct(at["words"].alias("start"), named.alias("label"))

    gated = lines.withColumn("_gate", gate).withColumn("_rules", _rule_table())
    return gated.select(
        id_col, (_blanks(line) - 1).cast("long").alias("n_words"),
        F.when(F.col("_gate"), F.transform(places(line, F.lit(alternatives)), base))
        .otherwise(F.array().cast("array<struct<start:int,label:string>>")).alias("base"),
        F.when(F.col("_gate"), unsuppressed(detections(line)))
        .otherwise(F.array().cast("array<struct<start:int,till:int,priority:int,label:string>>")).alias("found"))


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, places, labels and a score between 0 and 1 per document: the
    weight of the best priority found."""
    starts = F.transform("base", lambda b: b["start"])
    base = F.array_distinct(F.transform("base", lambda b: b["label"]))
    own = F.transform("found", lambda d: d["label"])
    weight = F.lit(0.0)
    for p in sorted(WEIGHT, reverse=True):
        here = F.array_contains(F.transform("found", lambda d: d["priority"]), p)
        weight = F.when(here, F.lit(WEIGHT[p])).otherwise(weight)
    return found.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.greatest(weight, F.when(F.size("base") > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0))).alias("score"))
