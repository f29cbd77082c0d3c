"""Operator 4: licence scan by sentence rules, in DataFrame operations only.

A text is normalised and searched for the sentences known from licence notices, which may run over line ends; the
identifiers found, in text order, are matched against ordered licence rules.  All of it is one expression over the row:
no shuffle, no exploded rows, and a long text stays one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (sentence identifier, pattern of the normalised sentence).  A blank in a pattern also stands for
# a line end or a mark, a pattern ends where a clause does.
SENTENCES = (
    ("apache2-grant", r"(this (file|work|program|project|software) is )?(licensed|released|distributed) under the (terms of the )?apache (software )?license (version |v)?2(\.0)?"),
    ("apache2-compliance", r"you may not use this file except in compliance with the license"),
    ("apache2-copy", r"you may obtain a copy of the license at( [^.,;\n]*)?"),
    ("mit-grant", r"(this (file|work|program|project|software) is )?(licensed|released|distributed) under the (terms of the )?mit (software )?license"),
    ("mit-permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd-redistribution", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-endorse", r"neither the name of [^.]*? may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-grant", r"(this (file|work|program|project|software) is )?(licensed|released|distributed) under (the|a) (terms of the )?(new |modified |simplified |2-clause |3-clause )?bsd( style|-style)? license"),
    ("gpl3-grant", r"(this (file|work|program|project|software) is )?(licensed|released|distributed) under the (terms of the )?gnu general public license (version 3|v3)(\.0)?"),
    ("gpl2-grant", r"(this (file|work|program|project|software) is )?(licensed|released|distributed) under the (terms of the )?gnu general public license (version 2|v2)(\.0)?"),
    ("lgpl-grant", r"(this (file|work|program|project|software) is )?(licensed|released|distributed) under the (terms of the )?gnu lesser general public license( (version |v)[23](\.[01])?)?"),
    ("agpl-grant", r"(this (file|work|program|project|software) is )?(licensed|released|distributed) under the (terms of the )?gnu affero general public license( (version |v)3(\.0)?)?"),
    ("gpl-any-grant", r"this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl3-or-later", r"either version 3 of the license or (at your option )?any later version"),
    ("or-later", r"(either version [23] of the license or )?(at your option )?any later version"),
    ("mpl2-grant", r"this source code form is subject to the terms of the mozilla public license (v|version) ?2\.0"),
    ("cc-by-nc-grant", r"(this (file|work|text|document) is )?(licensed|released|distributed) under (the )?(terms of the )?(cc by-nc|creative commons attribution-noncommercial)( (4|3)\.0)?( international)?( license)?"),
    ("cc-by-sa-grant", r"(this (file|work|text|document) is )?(licensed|released|distributed) under (the )?(terms of the )?(cc by-sa|creative commons attribution-sharealike)( (4|3)\.0)?( international)?( license)?"),
    ("cc-by-grant", r"(this (file|work|text|document) is )?(licensed|released|distributed) under (the )?(terms of the )?(cc by|creative commons attribution)( (4|3)\.0)?( international)?( license)?"),
    ("cc0-grant", r"(this (file|work|text|document) is )?(licensed|released|dedicated|placed) (under|to|in) (the )?(cc0( 1\.0)?|public domain)( dedication)?"),
    ("no-warranty", r"(this|the) (software|program) is (provided|distributed) (as is|in the hope that it will be useful)"),
    ("all-rights", r"all rights reserved"),
    ("copyright", r"(copyright|©) [^.;\n]*"),
)
# Ordered rules (licence, pattern over the identifiers, each followed by a blank).  The first that matches
# names the licence; identifiers it does not need may lie between.
RULES = (
    ("Apache-2.0", r"apache2-grant |apache2-compliance (\S+ )*?apache2-copy "),
    ("MIT", r"mit-permission (\S+ )*?mit-notice |mit-grant "),
    ("BSD-3-Clause", r"bsd-redistribution (\S+ )*?bsd-endorse "),
    ("BSD", r"bsd-redistribution |bsd-grant "),
    ("AGPL-3.0", r"agpl-grant "),
    ("LGPL", r"lgpl-grant "),
    ("GPL-3.0-or-later", r"gpl3-grant (\S+ )*?(gpl3-)?or-later |gpl-any-grant (\S+ )*?gpl3-or-later "),
    ("GPL-3.0", r"gpl3-grant "),
    ("GPL-2.0-or-later", r"(gpl2-grant|gpl-any-grant) (\S+ )*?or-later "),
    ("GPL-2.0", r"gpl2-grant "),
    ("GPL", r"gpl-any-grant "),
    ("MPL-2.0", r"mpl2-grant "),
    ("CC-BY-NC", r"cc-by-nc-grant "),
    ("CC-BY-SA", r"cc-by-sa-grant "),
    ("CC-BY", r"cc-by-grant "),
    ("CC0-1.0", r"cc0-grant "),
    ("Proprietary", r"all-rights "),
)
#: Every known sentence holds one of these; a text without any has no licence sentence.
CUE = r"(?i)licen[sc]e|redistribut|permission|warrant|provided|useful|free\s+software|domain|cc0|reserved|copyright|\(c\)|©|later|endorse"
#: What a text becomes before sentences are looked up: in order, pattern and replacement.  Of marks stay "." for the end of a
#: sentence or paragraph, ";" for a semicolon or colon, "," for commas, brackets and dashes, and line ends.
NORMAL = (
    (r"\r\n?", "\n"),
    (r"(?m)^[ \t]*+(?:<!--|[*#/;>%!|\"-]|dnl |rem )(?:[*#/;>%!|\" \t-])*+", ""),  # comment marks
    (r"\(c\)", "©"),
    (r"\bv(?:\.| ) ?(?=[0-9])", "v"),
    (r"[\"'`“”„‘’«»*_]|/(?=\s|$)|(?<=\s)/", ""),
    (r"\n[ \t]*+\n\s*+", " . "),
    (r"[.!?]++(?=\s|$)", " . "),
    (r"[;:](?=\s|$)", " ; "),
    (r"[,()\[\]{}—–]|-{2,}+|(?<=\s)-(?=\s)", " , "),
    (r"\n", " \n "),
    (r"[^\S\n]++", " "),
    (r"^[ \n]++|[ \n]++$", ""),
)
#: A blank in a pattern, what a sentence follows, and what follows its last word.
GAP, BEGIN = r" (?:[,;\n] ){0,4}", r"(?<=^|[.;\n] )"
END = r"(?= [.,;\n]|$| (?:and|or|as|see|which|that|by|in|for|with|unless|subject|to|at|provided|except)\b)"
#: Clauses that also follow a comma.
CLAUSES = frozenset(("gpl3-or-later", "or-later"))


def _spread(pattern: str) -> str:
    """``pattern`` with its groups uncounted and its blanks as gaps; blanks in front of a set or in "v ?" stay."""
    out = pattern.replace("(", "(?:").replace("\\(?:", "\\(").replace("(?:?", "(?")
    return out.replace(" ?", "\0?").replace(" [^.,;\\n]*", "\0[^.,;\\n]*").replace(" ", GAP).replace("\0", " ")


FORMS = tuple((name, _spread(p)) for name, p in SENTENCES)
ANY = "(?:" + "|".join((r"(?<=^|[.,;\n] )" if name in CLAUSES else BEGIN) + f"(?:{p}){END}" for name, p in FORMS) + ")"


def sentence_ids(text: Column) -> Column:
    """The identifiers of the licence sentences of a text, in order.  A sentence may run over line ends."""
    clean = F.lower(text)
    for pattern, new in NORMAL:
        clean = F.regexp_replace(clean, pattern, new)

    def known(s: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, pattern in reversed(FORMS):
            found = F.when(s.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(found)
        return found

    return F.transform(F.regexp_extract_all(clean, F.lit(ANY), F.lit(0)), known)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, license (null if no rule matches), licenses (all rules that match, in rule
    order), sentences (identifiers found, in text order).

    Null and empty texts have no sentences; repeated rows repeat; other columns are not read, so their names cannot
    clash; an empty table gives an empty result."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    some = docs.select(F.col(id_col).alias("doc_id"),
                       F.when(t.rlike(CUE), sentence_ids(t)).otherwise(F.array().cast("array<string>")).alias("sentences"))
    line = F.concat(F.array_join("sentences", " "), F.lit(" "))
    all_ = F.filter(F.array(*(F.when(line.rlike(p), F.lit(n)) for n, p in RULES)), lambda x: x.isNotNull())
    return (some.withColumn("licenses", F.when(F.size("sentences") > 0, all_).otherwise(F.array().cast("array<string>")))
            .select("doc_id", F.try_element_at("licenses", F.lit(1)).alias("license"), "licenses", "sentences"))
