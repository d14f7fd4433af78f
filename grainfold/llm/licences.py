"""Licence recognition by sentences: known sentences give identifiers, rules over their order give licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences in normalised form (lower case, letters and digits, single
#: blanks), as regular expressions that must match a whole sentence, with their identifiers.
SENTENCES = (
    ("GPL3", r"(this work|this program|this software|this file) is licensed under the gnu general public license version 3( or later)?|licensed under the gnu general public license version 3"),
    ("GPL2", r"(this work|this program|this software|this file) is licensed under the gnu general public license version 2( or later)?|licensed under the gnu general public license version 2"),
    ("GPLfree", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version \d of the license or at your option any later version"),
    ("GPLwarranty", r"this program is distributed in the hope that it will be useful but without any warranty.*"),
    ("Apache2", r"licensed under the apache license version 2 0( the license)?"),
    ("Apache2use", r"you may not use this file except in compliance with the license"),
    ("Apache2copy", r"you may obtain a copy of the license at.*"),
    ("MITname", r"(released|licensed|distributed) under (the )?mit license"),
    ("MITperm", r"permission is hereby granted free of charge to any person obtaining a copy of this software.*"),
    ("MITnotice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("MITwarranty", r"the software is provided as is without warranty of any kind.*"),
    ("BSDperm", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BSDendorse", r"neither the name of .* may be used to endorse or promote products derived from this software.*"),
    ("CCBYNC4", r"licensed under (a )?cc by nc 4 0"),
    ("CCBYSA4", r"licensed under (a )?cc by sa 4 0"),
    ("CCBY4", r"licensed under (a )?cc by 4 0"),
    ("Copyright", r"(copyright|c copyright) (c )?\d{4}.*"),
    ("AllRights", r"all rights reserved"),
    ("SPDX", r"spdx license identifier .*"),
)
#: Rules in order; each is a run of identifiers and the licence it means. What an
#: earlier rule has matched isn't seen by later ones.
RULES = (
    ("GPLfree,GPLwarranty", "GPL-or-later"),
    ("GPLfree", "GPL-or-later"),
    ("GPL3", "GPL-3.0"),
    ("GPL2", "GPL-2.0"),
    ("Apache2,Apache2use,Apache2copy", "Apache-2.0"),
    ("Apache2", "Apache-2.0"),
    ("MITperm,MITnotice,MITwarranty", "MIT"),
    ("MITname", "MIT"),
    ("BSDperm,BSDendorse", "BSD-3-Clause"),
    ("BSDperm", "BSD-2-Clause"),
    ("CCBYNC4", "CC-BY-NC-4.0"),
    ("CCBYSA4", "CC-BY-SA-4.0"),
    ("CCBY4", "CC-BY-4.0"),
    ("Copyright,AllRights", "proprietary"),
    ("AllRights", "proprietary"),
)
#: Every known sentence holds one of these; other texts are not cut into sentences.
CUES = "licen[sc]e|copyright|permission|permitted|warranty|endorse|rights reserved|spdx|cc[^a-z0-9]+by"
#: The known statements, looked for anywhere in a normalised sentence; those of an earlier
#: place win where two begin at the same word. The forms of ``SENTENCES`` follow without their open ends.
_FREE = "is free software you can redistribute it and or modify it under the terms of"
_FSF = "as published by the free software foundation"
_LATER = r"either version \d( \d)? of the license or at your option any later version"
STATEMENTS = (
    *[(f"{name}free", rf"({_FREE} |under the terms of )the {gnu} {_FSF} {_LATER}") for name, gnu in (("AGPL", "gnu affero general public license"), ("LGPL", "gnu (lesser|library) general public license"), ("GPL", "gnu general public license"))],
    *[
        (name, rf"(under|under the terms of) (the {gnu} ({_FSF} version {v}|(version |v )?{v} {_FSF}|(version |v|v ){v}( or later| only)?)|version {v} of the {gnu})")
        for name, gnu, v in (
            ("AGPL3", "gnu affero general public license", "3( 0)?"), ("LGPL3", "gnu lesser general public license", "3( 0)?"), ("LGPL21", "gnu lesser general public license", "2 1"),
            ("LGPL2", "gnu (lesser|library) general public license", "2( 0)?(?! 1)"), ("GPL3", "gnu general public license", "3( 0)?"), ("GPL2", "gnu general public license", "2( 0)?"),
        )
    ],
    ("GPLwarranty", r"is distributed in the hope that it will be useful but without any warranty"),
    ("Apache2", r"under (the terms of )?the apache license version 2( 0)?"),
    ("Apache2url", r"https? (www )?apache org licenses license 2 0"),
    ("MITname", r"under (the terms of )?(the )?mit license"),
    ("BSDadvert", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("BSDendorse", r"(neither the name .{1,400}?|nor the names of .{1,200}?|the name .{1,200}?) may (not )?be used to endorse or promote products derived from this software"),
    ("BSD3name", r"under (the terms of )?(the |a )?(bsd 3 clause|3 clause bsd|new bsd|modified bsd)( license)?"),
    ("BSD2name", r"under (the terms of )?(the |a )?(bsd 2 clause|2 clause bsd|simplified bsd)( license)?"),
    ("MPL11", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("MPL2", r"(subject to the terms of|under the terms of|under) the mozilla public license (v |version )?2 0"),
    ("EPL2", r"under (the terms of )?the eclipse public license (v |version )?2 0"),
    ("EPL1", r"under (the terms of )?the eclipse public license (v |version )?1 0"),
    ("Boost1", r"under the boost software license version 1 0"),
    ("ISC", r"permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("BSD0", r"permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("ISCname", r"under (the terms of )?(the )?isc license"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("Zlib", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    *[
        (f"CCBY{mark}4", rf"under (a |the )?(creative commons attribution{long} 4 0|cc by{short} 4 0)")
        for mark, long, short in (
            ("NCSA", " non ?commercial share ?alike", " nc sa"), ("NCND", " non ?commercial no ?deriv(ative)?s", " nc nd"), ("NC", " non ?commercial", " nc"), ("SA", " share ?alike", " sa"), ("ND", " no ?deriv(ative)?s", " nd"), ("", "", ""),
        )
    ],
    ("CC0", r"under (a |the )?(creative commons )?(cc0|zero) 1 0"),
    *[(name, pattern.removesuffix(".*").replace(".*", ".{1,400}?").strip()) for name, pattern in SENTENCES if name != "SPDX"],
)
_APACHE = ("Apache2,Apache2use,Apache2copy,Apache2url", "Apache2,Apache2use,Apache2copy", "Apache2,Apache2use", "Apache2use,Apache2copy,Apache2url", "Apache2copy,Apache2url", "Apache2,Apache2url", "Apache2url")
_WHOLE = (
    ("BSDperm,BSDadvert,BSDendorse", "BSD-4-Clause"), ("BSDperm,BSDendorse", "BSD-3-Clause"), ("BSDperm", "BSD-2-Clause"),
    ("MITperm,MITnotice,MITwarranty", "MIT"), ("MITperm,MITnotice", "MIT"), ("ISC,MITwarranty", "ISC"), ("ISC", "ISC"), ("BSD0,MITwarranty", "0BSD"), ("BSD0", "0BSD"),
)
#: Rules ahead of ``RULES``. "All rights reserved" right before the text of a free licence belongs to that text.
MORE_RULES = (
    ("MPL11,Apache2use,Apache2copy", "MPL-1.1"), ("MPL11,Apache2use", "MPL-1.1"), ("MPL11", "MPL-1.1"),
    *[(run, "Apache-2.0") for run in _APACHE],
    *[(first + run, name) for run, name in _WHOLE for first in ("Copyright,AllRights,", "AllRights,", "")],
    *[(run, f"{name}-or-later") for name in ("AGPL", "LGPL") for run in (f"{name}free,GPLwarranty", f"{name}free")],
    *[(run, name) for one, name in (("AGPL3", "AGPL-3.0"), ("LGPL3", "LGPL-3.0"), ("LGPL21", "LGPL-2.1"), ("LGPL2", "LGPL-2.0"), ("GPL3", "GPL-3.0"), ("GPL2", "GPL-2.0")) for run in (f"{one},GPLwarranty", one)],
    ("BSD3name", "BSD-3-Clause"), ("BSD2name", "BSD-2-Clause"), ("MPL2", "MPL-2.0"), ("EPL2", "EPL-2.0"), ("EPL1", "EPL-1.0"), ("Boost1", "BSL-1.0"), ("ISCname", "ISC"),
    ("Unlicense,MITwarranty", "Unlicense"), ("Unlicense", "Unlicense"), ("Zlib", "Zlib"), ("CC0", "CC0-1.0"),
    ("CCBYNCSA4", "CC-BY-NC-SA-4.0"), ("CCBYNCND4", "CC-BY-NC-ND-4.0"), ("CCBYND4", "CC-BY-ND-4.0"),
)
#: Every statement's sentence holds one of these, also if it is wrapped.
MORE_CUES = "licen[sc]e|copyright|permission|permitted|warranty|endorse|acknowledge?ment|reserved|spdx|cc[^a-z0-9]+by|cc0|free software|creative|public[^a-z0-9]+domain"
#: A licence expression behind the SPDX tag.
_SPDX_ID = "[A-Za-z0-9][A-Za-z0-9.+:-]*"
SPDX = rf"(?i)spdx-license-identifier:[( \t]*{_SPDX_ID}(?:[) \t]+(?:and|or|with)[( \t]+{_SPDX_ID}){{0,50}}"


def normalised(sentence: Column) -> Column:
    """Lower case, with runs of anything but letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentences(text: Column) -> Column:
    """Sentences of a text: cut at lines without letters and digits and behind a full stop, question or exclamation mark.

    Other line ends are blanks, together with the comment marks behind them. White space has to follow the full
    stop, and no small letter or digit ("Inc. nor", "v. 2.0"). SPDX tags are sentences up to the line's end.
    """
    text = F.regexp_replace(text, "\\x0D\\x0A?", "\n")
    text = F.regexp_replace(text, "(?i)(spdx-license-identifier:[^\n]*)", "\n\n$1\n\n")
    text = F.regexp_replace(text, "\n(?:[^A-Za-z0-9\n]*+\n)++", "\u0001")
    text = F.regexp_replace(text, "\n[^A-Za-z0-9\n\u0001]*+(?:(?:dnl|rem|REM)(?= )[^A-Za-z0-9\n\u0001]*+)?", " ")
    return F.split(F.regexp_replace(text, r"([.!?])[\x20\x09-\x0D]++(?![a-z0-9])", "$1\u0001"), "\u0001")


def sentence_ids(sentence: Column) -> Column:
    """Identifiers of the known statements in a sentence, in order; SPDX tags give one for each licence they name."""
    found = F.regexp_extract_all(normalised(sentence), F.lit("\\b(?:" + "|".join(f"(?:{p})" for _, p in STATEMENTS) + ")\\b"), F.lit(0))

    def name(statement: Column) -> Column:
        out = None
        for name, pattern in STATEMENTS:
            test = statement.rlike(f"^(?:{pattern})$")
            out = F.when(test, name) if out is None else out.when(test, name)
        return out

    plain = F.regexp_replace(F.regexp_substr(sentence, F.lit(SPDX)), "(?i)^spdx-license-identifier:|[) \t]with[( \t]+[^) \t]+", " ")
    named = F.filter(F.regexp_extract_all(plain, F.lit(_SPDX_ID), F.lit(0)), lambda s: ~F.lower(s).isin("and", "or"))
    tags = F.coalesce(F.transform(named, lambda s: F.concat(F.lit("SPDX="), s)), F.array(F.lit("SPDX")))
    return F.when(sentence.rlike("(?i)^spdx-license-identifier:"), tags).otherwise(F.transform(found, name))


def recognise_licences(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Licences of each document: the key, ``sentence_ids`` (in text order), ``licences`` and ``unmatched``.

    ``licences`` are the names given by the rules, each once, in the order of the rules, then those that SPDX tags
    name (identifiers ``SPDX=...``); ``unmatched`` counts known statements that no rule took. A statement is known
    at word boundaries anywhere in a sentence, wrapped or not, and a sentence may hold several.
    Null, empty or plain texts give empty arrays and 0. Every row gives one row; other columns don't matter.
    """
    has_cue = F.coalesce(F.lower(F.col(text)).rlike(MORE_CUES), F.lit(False))
    none = F.array().cast("array<string>")
    cued = F.filter(sentences(F.col(text)), lambda s: F.lower(s).rlike(MORE_CUES))
    rows = docs.select(F.col(key), F.when(has_cue, F.flatten(F.transform(cued, sentence_ids))).otherwise(none).alias("sentence_ids"))
    rest = F.concat(F.lit(","), F.array_join("sentence_ids", ",,"), F.lit(","))
    rules = F.array(*[F.struct(F.lit("," + run.replace(",", ",,") + ",").alias("mark"), F.lit(name).alias("name")) for run, name in MORE_RULES + RULES])

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["mark"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["mark"], F.lit(",;,"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    start = F.struct(rest.alias("rest"), none.alias("names"))
    ruled = F.aggregate(rules, start, apply)
    rows = rows.withColumn("_ruled", F.when(F.size("sentence_ids") > 0, ruled).otherwise(F.struct(F.lit("").alias("rest"), none.alias("names"))))
    tagged = F.transform(F.filter("sentence_ids", lambda s: s.startswith("SPDX=")), lambda s: F.substring(s, F.lit(6), F.length(s)))
    left = F.size(F.filter(F.split("_ruled.rest", ","), lambda s: (s != "") & (s != ";") & ~s.startswith("SPDX=")))
    return rows.select(key, "sentence_ids", F.array_distinct(F.concat("_ruled.names", tagged)).alias("licences"), left.cast("long").alias("unmatched"))


def licences_sql(documents: str = "documents") -> str:
    """``SENTENCES`` and ``RULES`` in DuckDB, on statements that close a line or sentence; arrays joined by commas."""
    known = " ".join(f"WHEN regexp_matches(s, '(^| )({pattern})$') THEN '{name}'" for name, pattern in SENTENCES)
    rest, names = "CASE WHEN len(ids) > 0 THEN ',' || array_to_string(ids, ',,') || ',' ELSE '' END", []
    steps = f"SELECT doc_id, ids, {rest} AS r0 FROM known"
    for i, (run, name) in enumerate(RULES):
        mark = "," + run.replace(",", ",,") + ","
        steps = f"SELECT *, CASE WHEN contains(r{i}, '{mark}') THEN '{name}' END AS h{i}, replace(r{i}, '{mark}', ',;,') AS r{i + 1} FROM ({steps})"
        names.append(f"h{i}")
    order = ", ".join(f"'{name}'" for name in dict.fromkeys(name for _, name in RULES))
    cue = CUES.replace("'", "''")
    return f"""
    WITH cut AS (
        SELECT doc_id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), '[\x0A\x0D]+'),
            lambda s: regexp_matches(lower(s), '{cue}')) AS ss FROM {documents}
    ), plain AS (SELECT doc_id, list_transform(ss, lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))) AS ss FROM cut
    ), known AS (SELECT doc_id, list_filter(list_transform(ss, lambda s: CASE {known} END), lambda s: s IS NOT NULL) AS ids FROM plain)
    SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
        array_to_string(list_filter([{order}], lambda n: list_contains([{", ".join(names)}], n)), ',') AS licences,
        CAST(len(list_filter(string_split(r{len(RULES)}, ','), lambda s: s <> '' AND s <> ';')) AS BIGINT) AS unmatched
    FROM ({steps})
    """
