"""Operator 2: license scans by ordered signature rules.

A text is normalised to its lower-case words, one space between two. Rules are regular expressions over that form, each
with a keyword that must stand in the text before the expression is tried, a priority and a confidence. Of overlapping
detections, one that lies inside another of the same or a better priority is suppressed.

Defined results: null texts are empty and have no words; a text without detections has empty labels and score 0; rows
with equal ids are scanned one by one; whole texts are scanned; extra columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Phrases of words and the labels they stand for.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: label, expression for its name, keywords of which every text with that name contains one.
NAMES = (
    ("gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)", "general public licen|gpl"),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl)", "lesser general public|library general public|lgpl"),
    ("agpl", r"(?:gnu )?(?:affero general public licen[sc]e|agpl)", "affero|agpl"),
    ("gfdl", r"(?:gnu )?(?:free documentation licen[sc]e|gfdl)", "free documentation|gfdl"),
    ("apache", r"apache (?:software )?licen[sc]e", "apache"),
    ("mit", r"(?:mit|expat|x11) licen[sc]e", "mit licen|expat licen|x11 licen"),
    ("bsd", r"bsd licen[sc]e", "bsd"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)(?: licen[sc]e)?", "bsd"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", "bsd"),
    ("0bsd", r"(?:zero clause bsd|0bsd|bsd zero clause)(?: licen[sc]e)?", "zero clause|0bsd"),
    ("isc", r"isc licen[sc]e", "isc licen"),
    ("mpl", r"(?:mozilla public licen[sc]e|mpl)", "mozilla public|mpl"),
    ("epl", r"(?:eclipse public licen[sc]e|epl)", "eclipse public|epl"),
    ("cddl", r"(?:common development and distribution licen[sc]e|cddl)", "common development and|cddl"),
    ("cpl", r"common public licen[sc]e", "common public"),
    ("cc-by", r"(?:cc|creative commons) (?:by|attribution)", "cc by|creative commons"),
    ("cc-by-sa", r"(?:cc|creative commons) (?:by sa|attribution share ?alike)", "cc by|creative commons"),
    ("cc-by-nd", r"(?:cc|creative commons) (?:by nd|attribution no ?deriv\w*)", "cc by|creative commons"),
    ("cc-by-nc", r"(?:cc|creative commons) (?:by nc|attribution non ?commercial)", "cc by|creative commons"),
    ("cc-by-nc-sa", r"(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)", "cc by|creative commons"),
    ("cc-by-nc-nd", r"(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv\w*)", "cc by|creative commons"),
    ("cc0", r"(?:cc0|cc zero|creative commons zero)", "cc0|cc zero|creative commons zero"),
    ("unlicense", r"(?:the )?unlicen[sc]e", "unlicen"),
    ("wtfpl", r"(?:do what the \w+ you want to public licen[sc]e|wtfpl)", "you want to public|wtfpl"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib"),
    ("boost", r"(?:boost software licen[sc]e|bsl 1 0)", "boost software|bsl 1 0"),
    ("artistic", r"artistic licen[sc]e", "artistic"),
    ("python", r"(?:python (?:software foundation )?licen[sc]e|psf licen[sc]e)", "python|psf"),
    ("php", r"php licen[sc]e", "php"),
    ("ruby", r"ruby licen[sc]e", "ruby"),
    ("openssl", r"openssl licen[sc]e", "openssl"),
    ("w3c", r"w3c (?:software (?:notice and )?)?licen[sc]e", "w3c"),
    ("ofl", r"(?:sil )?open font licen[sc]e", "open font"),
    ("odbl", r"(?:open (?:data commons )?(?:open )?database licen[sc]e|odbl)", "database licen|odbl"),
    ("odc-by", r"(?:open data commons attribution licen[sc]e|odc by)", "open data commons|odc by"),
    ("eupl", r"(?:european union public licen[sc]e|eupl)", "european union public|eupl"),
    ("ms-pl", r"microsoft public licen[sc]e", "microsoft"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "microsoft"),
    ("postgresql", r"postgresql licen[sc]e", "postgresql"),
    ("ncsa", r"(?:ncsa|university of illinois) open source licen[sc]e", "open source"),
    ("openrail", r"(?:bigscience |creativeml )?open ?rail(?: m)?(?: licen[sc]e)?", "rail"),
    ("afl", r"academic free licen[sc]e", "academic free"),
    ("osl", r"open software licen[sc]e", "open software"),
    ("qpl", r"q public licen[sc]e", "q public"),
    ("ipl", r"ibm public licen[sc]e", "ibm"),
    ("vim", r"vim licen[sc]e", "vim"),
    ("beerware", r"beer ?ware(?: licen[sc]e)?", "beer"),
    ("public-domain", r"public domain", "public domain"),
    ("proprietary", r"all rights reserved", "all rights reserved"),
)

#: Expressions for the SPDX ids of names that are not written so themselves, and the words that grants by id begin with.
IDS = {
    "apache": (r"apache \d \d", "apache"),
    "mit": (r"(?:mit(?: 0)?|x11)", "mit|x11"),
    "bsd": (r"bsd", "bsd"),
    "isc": (r"isc", "isc"),
    "cpl": (r"cpl", "cpl"),
    "zlib": (r"zlib", "zlib"),
    "artistic": (r"artistic", "artistic"),
    "python": (r"(?:python|psf)", "python|psf"),
    "php": (r"php", "php"),
    "ruby": (r"ruby", "ruby"),
    "openssl": (r"openssl", "openssl"),
    "w3c": (r"w3c", "w3c"),
    "ofl": (r"ofl", "ofl"),
    "ms-pl": (r"ms pl", "ms pl"),
    "ms-rl": (r"ms rl", "ms rl"),
    "postgresql": (r"postgresql", "postgresql"),
    "ncsa": (r"ncsa", "ncsa"),
    "afl": (r"afl", "afl"),
    "osl": (r"osl", "osl"),
    "qpl": (r"qpl", "qpl"),
    "ipl": (r"ipl", "ipl"),
    "vim": (r"vim", "vim"),
}
#: Ids that are programs too: 'available under python 3' grants nothing, 'licensed under' does.
PROGRAMS = ("python", "php", "ruby", "openssl", "w3c", "postgresql", "vim")
#: What may follow an id.
TAIL = r"(?: v?\d+(?: \d+)*)?(?: only| or later)?(?: with (?:[a-z0-9]+ ){1,4}exception(?: \d+ \d+)?)?"
#: Ids that an SPDX expression (a or b and c) may have; a worse priority keeps those before from being suppressed.
OPERANDS = 4

#: label, characteristic sentence of the license's body, a keyword in it.
BODIES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall"),
    ("isc", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided", "fee is hereby granted"),
    ("0bsd", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted(?! provided)", "fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that", "redistribution and use"),
    ("bsd-3-clause", r"neither the names? of (?:[^ ]+ ){1,20}may be used to endorse or promote products derived from this software", "neither the name"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "all advertising materials"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e", "program is free software"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e", "library is free software"),
    ("agpl", "your modified version must prominently offer all users interacting with it remotely", "must prominently offer"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation", "modify this document"),
    ("apache", "you may not use this file except in compliance with the license", "except in compliance with"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "unless required by applicable law"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "this source code form"),
    ("epl", "the accompanying materials are made available under the terms of the eclipse public license", "accompanying materials"),
    ("cddl", "cddl header start", "cddl header"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", "altered source versions must be plainly marked as such", "altered source versions"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "hereby granted free of charge"),
    ("wtfpl", r"you just do what the [^ ]+ you want to", "you just do what"),
    ("cc0", "has dedicated the work to the public domain by waiving all of his or her rights", "dedicated the work"),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made", "give appropriate credit"),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license", "distribute your contributions"),
    ("cc-by-nc", "you may not use the material for commercial purposes", "the material for commercial"),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material", "distribute the modified material"),
    ("postgresql", "for any purpose without fee and without a written agreement is hereby granted", "a written agreement is hereby"),
    ("w3c", "with or without modification for any purpose and without fee or royalty is hereby granted", "or royalty is hereby granted"),
    ("python", "psf hereby grants licensee a nonexclusive royalty free world ?wide license", "psf hereby grants"),
    ("php", "products derived from this software may not be called php", "may not be called php"),
    ("openssl", "this product includes software developed by the openssl project", "openssl project"),
    ("artistic", r"you may (?:make and give away|distribute) verbatim copies of the (?:source form of the )?standard version of this package", "standard version of this package"),
    ("ofl", r"the font software may be sold as part of a larger software package|neither the font software nor any of its individual components", "font software"),
    ("ncsa", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers", "the following disclaimers"),
    ("ms-pl", "if you bring a patent claim against any contributor over patents that you claim are infringed by the software", "bring a patent claim"),
    ("vim", "there are no restrictions on distributing unmodified copies of vim", "unmodified copies of vim"),
    ("openrail", "you agree not to use the model or derivatives of the model", "derivatives of the model"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer in return", "if we meet some day"),
)

#: kind, expression around a name ({name}), priority (0 is best), confidence.
FORMS = (
    ("grant", r"(?:licensed|released|distributed|available|published|provided|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?{name}(?: (?:version |v)?\d+(?: \d+)*)?", 1, 0.95),
    ("version", r"{name}(?: licen[sc]e)? (?:version |v)?\d+(?: \d+)*(?: or (?:any )?later)?", 2, 0.85),
    ("copy", r"(?:copy|text|terms) of (?:the )?{name}", 2, 0.8),
    ("name", r"{name}", 3, 0.7),
)
PRIORITIES = 4

#: Parts of words; a text without any of them contains no license name or body, and a grant by id only where GRANT_GATE
#: does. They begin with different rare letters, so that
#: a look for each is one quick pass.
GATE = ("licen", "spdx", "cc by ", "cc zero ", "cc0", "creative commons", "public domain", "rights reserved", "gpl", "gfdl", "bsd", "mpl", "epl", "cddl", "wtfpl", "odbl", "odc by", "eupl", "rail", "beer", "bsl 1", *sorted({word for _, _, word in BODIES}))


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: str
    priority: int
    confidence: float


def _grant_words(label: str) -> list[str]:
    return [lead + word for word in IDS[label][1].split("|") for lead in ("under ", "under the ", "under terms of ", "under terms of the ", "under the terms of ", "under the terms of the ")]


#: A text that lacks ' under ' and this has no grant by id.
GRANT_GATE = r" under (?:the )?(?:terms of (?:the )?)?(?:" + "|".join(word for _, words in IDS.values() for word in words.split("|")) + ")"


def default_rules() -> list[Rule]:
    """The SPDX ids, every form of every name, and the bodies, in order."""
    between = r"(?<= )(?:{})(?= )"
    spdx = {label: f"(?:{name}|{IDS[label][0]})" if label in IDS else f"(?:{name})" for label, name, _ in NAMES}
    any_id = f"(?:{'|'.join(spdx.values())}){TAIL} (?:or|and) "
    rules = []
    for label, name, word in NAMES:
        for n in range(OPERANDS):
            before = f"(?:{any_id}){{{n}}}" if n else ""
            rules.append(Rule(label, between.format(f"spdx licen[sc]e identifier {before}{spdx[label]}{TAIL}"), "spdx licen", n, 1.0))
        if label in IDS:
            verbs = "licensed" if label in PROGRAMS else "licensed|released|distributed|available|published|provided|covered"
            rules.append(Rule(label, between.format(f"(?:{verbs}) under (?:the )?(?:terms of (?:the )?)?{IDS[label][0]}{TAIL}"), "|".join(_grant_words(label)), 1, 0.95))
        rules += [Rule(label, between.format(form.format(name=name)), word, priority, confidence) for _, form, priority, confidence in FORMS]
    return rules + [Rule(label, between.format(body), word, 1, 0.9) for label, body, word in BODIES]


def normalised(text: Column) -> Column:
    """' w1 w2 ... wn ', or one space for a text without words. lower() also lower-cases letters beyond ASCII, which makes
    no difference: no rule has such letters, and they stay within their words."""
    body = F.trim(F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(body == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), body, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def base_places(norm: Column, n_words: Column, phrase: str) -> Column:
    """(n, first, last): places of a phrase, and the words at which the first and the last one start."""
    size = len(phrase.split())
    pieces = F.split(norm, f"(?<= ){phrase}(?= )")
    found = F.transform(
        F.array(pieces),
        lambda p: F.struct(
            (F.size(p) - 1).cast("long").alias("n"),
            (_spaces(p[0]) - 1).cast("long").alias("first"),
            (n_words - (_spaces(F.element_at(p, -1)) - 1) - size).cast("long").alias("last"),
        ),
    )[0]
    return F.when(F.contains(norm, F.lit(f" {phrase} ")), found)


def _rule_array(rules: list[Rule]) -> Column:
    """The rules as one constant, which the optimizer folds."""
    words = lambda r: ", ".join(f"'{k}'" for k in r.keywords.split("|"))
    rows = [f"named_struct('label', '{r.label}', 'pattern', r'{r.pattern}', 'keywords', array({words(r)}), 'priority', {r.priority}, 'confidence', {r.confidence}D)" for r in rules]
    return F.expr(f"array({', '.join(rows)})")


def _matches(norm: Column, rule: Column) -> Column:
    """Spans of a rule's matches: (start, end, priority, label, confidence), in characters of norm."""
    empty = F.array().cast("array<struct<start:int,stop:int,priority:int,label:string,confidence:double>>")
    found, pieces = F.regexp_extract_all(norm, rule["pattern"], F.lit(0)), F.split(norm, rule["pattern"])
    pairs = F.filter(F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("p"), m.alias("m"))), lambda x: x["m"].isNotNull())

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        stop = start + F.length(x["m"])
        span = F.struct(start.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["confidence"].alias("confidence"))
        return F.struct(stop.alias("at"), F.array_append(acc["out"], span).alias("out"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def _unsuppressed(spans: Column) -> Column:
    """Spans without those inside a span of the same or a better priority; one pass over them in order of start, longer
    ones first, with the farthest end so far of each priority."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("back"), s["priority"].alias("priority"), s["label"].alias("label"), s["confidence"].alias("confidence"))))
    kept = F.array().cast("array<struct<start:int,stop:int,priority:int,label:string,confidence:double>>")

    def step(acc: Column, s: Column) -> Column:
        stop = -s["back"]
        inside = F.lit(False)
        for p in range(PRIORITIES):
            inside = inside | ((s["priority"] >= p) & (acc[f"far{p}"] >= stop))
        span = F.struct(s["start"].alias("start"), stop.alias("stop"), s["priority"].alias("priority"), s["label"].alias("label"), s["confidence"].alias("confidence"))
        far = [F.when(s["priority"] == p, F.greatest(acc[f"far{p}"], stop)).otherwise(acc[f"far{p}"]).alias(f"far{p}") for p in range(PRIORITIES)]
        return F.struct(*far, F.when(inside, acc["out"]).otherwise(F.array_append(acc["out"], span)).alias("out"))

    start = F.struct(*[F.lit(-1).alias(f"far{p}") for p in range(PRIORITIES)], kept.alias("out"))
    return F.aggregate(ordered, start, step, lambda acc: acc["out"])


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections): a row per document.
    Everything is worked out within the row, so nothing is shuffled."""
    rules = _rule_array(rules or default_rules())
    rows = docs.select("doc_id", normalised(text_of()).alias("norm")).withColumn("n_words", (_spaces(F.col("norm")) - 1).cast("long"))
    gate = F.lit(False)
    for word in GATE:
        gate = gate | F.contains("norm", F.lit(word))
    gate = gate | (F.contains("norm", F.lit(" under ")) & F.col("norm").rlike(GRANT_GATE))
    empty = F.array().cast("array<struct<start:int,stop:int,priority:int,label:string,confidence:double>>")
    tried = F.filter(rules, lambda r: F.exists(r["keywords"], lambda k: F.contains(F.col("norm"), k)))
    spans = F.flatten(F.transform(tried, lambda r: _matches(F.col("norm"), r)))
    rows = rows.withColumn("detections", F.when(gate, _unsuppressed(spans)).otherwise(empty))
    rows = rows.withColumn("places", F.array(*[base_places(F.col("norm"), F.col("n_words"), phrase) for phrase, _ in BASE]))
    base = F.filter(F.array(*[F.when(F.col("places")[i].isNotNull(), F.lit(label)) for i, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull())
    rows = rows.withColumn("base", F.array_sort(F.array_distinct(base)))
    found = F.transform("detections", lambda d: d["label"])
    n = F.aggregate(F.col("places"), F.lit(0).cast("long"), lambda acc, p: acc + F.coalesce(p["n"], F.lit(0)))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        n.alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["last"])).alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, 0.9).otherwise(0.0)).alias("score"),
        "detections",
    )
