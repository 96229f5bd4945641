"""License scans by sentence rules. [native: DataFrame functions only]

A text is cut into sentences, each sentence is normalised and looked up among
known licence sentences, and the sequence of identifiers is matched against
ordered rules. All of it happens inside the row: there is no shuffle, so hot
sources and copies cost nothing extra.

Licences are wrapped at line ends, headers are lines of their own. So a piece
between sentence ends is looked up whole, its line ends read as blanks, and
only where it is unknown line by line.

An SPDX tag and the rest of its line are a piece of their own, read as an expression: the
name at its start and after every OR, AND and WITH is looked up among licence names, so
all licences of an expression are reported in its order. Exceptions are no licences.

Cases: a null or empty text has no sentence; identical rows get identical
results; extra columns are kept by ``recognise``; sentences that no rule uses
are reported as ``unmatched``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymend.llm.common import text_or_empty

ENDS = r"[.!?;:]+[ \t\r\n]+|\n[ \t\r]*\n"
# A tag with the rest of its line, what it becomes, and how an expression is read.
# No repeated groups: their matching would take stack in proportion to a long line.
TAG = r"(?i)spdx-license(?:-identifier)?[ \t]*:[ \t]*([^\r\n]*)"
MARK = "spdx-license-identifier "
OPERATOR = r"(?i)[ \t)]+(?:or|and|with)[ \t(]+"
NAME = r"^[ \t(\"']*([a-z0-9.+-]*[a-z0-9+])"
# An expression ends with the first part that holds more than a name.
BARE = r"^[ \t(\"']*[A-Za-z0-9.+-]+[ \t)]*$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = "[^a-z0-9.+/-]+"
# The name in "Neither the name of X nor the names of ..." varies and goes too, also one that ends
# in a stop, such as "Foo Inc.", where ENDS has cut.
EDGE = r"^[ .+/-]*(?:neither the name of .+ )?nor the names of |^[ .+/-]+|[ .+/-]+$"
# Every known sentence holds one of these; a text without any is done at once. Single words only:
# what stands between two words of a sentence may be a line end or a comment mark.
HINT = "(?i)licen|copyright|permi|redistribut|warrant|unencumbered|spdx|provided|liab|notice|reserved|apache|gpl|bsd"

# Known sentences in normal form, and their identifiers.
SENTENCES = (
    ("ApacheRef", "licensed under the apache license version 2.0"),
    ("ApacheRef", "licensed under the apache license version 2.0 the license"),
    ("ApacheMayNot", "you may not use this file except in compliance with the license"),
    ("ApacheObtain", "you may obtain a copy of the license at"),
    (
        "ApacheAsIs",
        "unless required by applicable law or agreed to in writing software distributed under the"
        " license is distributed on an as is basis without warranties or conditions of any kind"
        " either express or implied",
    ),
    ("ApacheTitle", "apache license version 2.0"),
    ("MitRef", "released under the mit license"),
    ("MitRef", "licensed under the mit license"),
    ("MitTitle", "the mit license mit"),
    ("MitTitle", "the mit license"),
    ("MitTitle", "mit license"),
    (
        "MitGrant",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files the software to deal in the software without"
        " restriction including without limitation the rights to use copy modify merge publish"
        " distribute sublicense and/or sell copies of the software and to permit persons to whom the"
        " software is furnished to do so subject to the following conditions",
    ),
    (
        "MitNotice",
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software",
    ),
    (
        "MitAsIs",
        "the software is provided as is without warranty of any kind express or implied including"
        " but not limited to the warranties of merchantability fitness for a particular purpose and"
        " noninfringement",
    ),
    ("GplRef3", "this work is licensed under the gnu general public license version 3"),
    ("GplRef3", "licensed under the gnu general public license version 3"),
    ("GplRef2", "this work is licensed under the gnu general public license version 2"),
    ("GplRef2", "licensed under the gnu general public license version 2"),
    (
        "GplFree",
        "this program is free software you can redistribute it and/or modify it under the terms of"
        " the gnu general public license as published by the free software foundation either version"
        " 3 of the license or at your option any later version",
    ),
    # The usual notices, as ENDS cuts them: "free software: you can ...", "Foundation; either ...".
    (
        "GplFree",
        "you can redistribute it and/or modify it under the terms of the gnu general public license"
        " as published by the free software foundation either version 3 of the license or at your"
        " option any later version",
    ),
    (
        "GplTerms",
        "you can redistribute it and/or modify it under the terms of the gnu general public license"
        " as published by the free software foundation",
    ),
    (
        "LgplTerms",
        "you can redistribute it and/or modify it under the terms of the gnu lesser general public"
        " license as published by the free software foundation",
    ),
    (
        "LibraryTerms",
        "you can redistribute it and/or modify it under the terms of the gnu library general public"
        " license as published by the free software foundation",
    ),
    (
        "AgplTerms",
        "you can redistribute it and/or modify it under the terms of the gnu affero general public"
        " license as published by the free software foundation",
    ),
    ("LgplLater21", "either version 2.1 of the license or at your option any later version"),
    ("GplLater2", "either version 2 of the license or at your option any later version"),
    ("GplLater3", "either version 3 of the license or at your option any later version"),
    ("LgplRef3", "licensed under the gnu lesser general public license version 3"),
    ("AgplRef3", "licensed under the gnu affero general public license version 3"),
    ("Mpl2Ref", "licensed under the mozilla public license version 2.0"),
    (
        "Mpl2Terms",
        "this source code form is subject to the terms of the mozilla public license v",
    ),
    ("CcByNc4", "licensed under cc by-nc 4.0"),
    ("CcBySa4", "licensed under cc by-sa 4.0"),
    ("CcByNd4", "licensed under cc by-nd 4.0"),
    ("CcBy4", "licensed under cc by 4.0"),
    (
        "CcBy4",
        "this work is licensed under a creative commons attribution 4.0 international license",
    ),
    ("Cc0", "licensed under cc0 1.0"),
    (
        "BsdGrant",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    (
        "BsdSource",
        "redistributions of source code must retain the above copyright notice this list of"
        " conditions and the following disclaimer",
    ),
    (
        "BsdBinary",
        "redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution",
    ),
    (
        "BsdName",
        "its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission",
    ),
    (
        "BsdName",
        "the name of the author may not be used to endorse or promote products derived from this"
        " software without specific prior written permission",
    ),
    ("BsdRef", "licensed under the bsd license"),
    (
        "IscGrant",
        "permission to use copy modify and/or distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this permission"
        " notice appear in all copies",
    ),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
    ("AllRights", "copyright all rights reserved"),
    ("AllRights", "all rights reserved"),
)

# The names of the GNU licences and their versions, and of the Creative Commons 4.0 ones.
GNU = (
    ("GPL", "gnu general public license", ("2", "3")),
    ("LGPL", "gnu lesser general public license", ("2.1", "3")),
    ("LGPL", "gnu library general public license", ("2",)),
    ("AGPL", "gnu affero general public license", ("3",)),
)
CREATIVE = (
    ("CC-BY-4.0", "attribution"),
    ("CC-BY-SA-4.0", "attribution-sharealike"),
    ("CC-BY-NC-4.0", "attribution-noncommercial"),
    ("CC-BY-ND-4.0", "attribution-noderivatives"),
    ("CC-BY-NC-SA-4.0", "attribution-noncommercial-sharealike"),
    ("CC-BY-NC-ND-4.0", "attribution-noncommercial-noderivatives"),
)
# Further names that SPDX expressions use, under which they are reported.
NAMES = (
    "MIT", "Apache-1.1", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD",
    "ISC", "Zlib", "Unlicense", "WTFPL", "CC0-1.0", "CC-BY-3.0", "CC-BY-SA-3.0", "MPL-1.1", "MPL-2.0",
    "EPL-1.0", "EPL-2.0", "CDDL-1.0", "BSL-1.0", "Artistic-2.0", "PostgreSQL", "Python-2.0", "OFL-1.1",
)


def _version(number: str) -> str:
    return number if "." in number else f"{number}.0"


def standing_sentences() -> tuple[tuple[str, str], ...]:
    """Sentences that name licence and version, under ``Is:`` and the licence's name.

    The GNU notices stand in three forms: a version or any later, in one sentence where a comma
    joins it; a version alone, before or after the licence's name; and by reference.
    """
    free = "you can redistribute it and/or modify it under the terms of"
    foundation = "as published by the free software foundation"
    later = "or at your option any later version"
    found = {}
    for family, title, versions in GNU:
        for v in versions:
            exact, newer = f"Is:{family}-{_version(v)}", f"Is:{family}-{_version(v)}-or-later"
            for start in ("", "this program is free software ", "this library is free software "):
                found[f"{start}{free} the {title} {foundation} either version {v} of the license {later}"] = newer
                found[f"{start}{free} the {title} version {v} {foundation}"] = exact
                found[f"{start}{free} the {title} version {v} only {foundation}"] = exact
                found[f"{start}{free} version {v} of the {title} {foundation}"] = exact
            for written in dict.fromkeys((v, _version(v))):
                for start in ("", "this work is ", "this program is ", "this library is "):
                    found[f"{start}licensed under the {title} version {written}"] = exact
    for name, words in CREATIVE:
        for start in ("this work is licensed under", "licensed under"):
            for article in ("a", "the"):
                found[f"{start} {article} creative commons {words} 4.0 international license"] = f"Is:{name}"
    return tuple((name, sentence) for sentence, name in found.items())


def spdx_names() -> dict[str, str]:
    """Names of SPDX expressions in lower case, and the licence each stands for."""
    names = {n.lower(): n for n in (*NAMES, *(name for name, _ in CREATIVE))}
    for family, _, versions in GNU:
        for v in map(_version, versions):
            whole = f"{family}-{v}"
            names |= {f"{whole}{end}".lower(): whole for end in ("", "-only")}
            names |= {f"{whole}{end}".lower(): f"{whole}-or-later" for end in ("+", "-or-later")}
    return names


# A rights-reserved notice on top of a full licence text is part of it.
# Ordered: an earlier rule takes its identifiers before a later one sees them.
# ``A B? | C`` reads: A, then perhaps B; or C.
RULES = (
    ("MIT", "MitTitle? AllRights? MitGrant MitNotice MitAsIs?"),
    ("Apache-2.0", "ApacheTitle? AllRights? ApacheRef ApacheMayNot? ApacheObtain? ApacheAsIs?"),
    ("BSD-3-Clause", "AllRights? BsdGrant BsdSource BsdBinary BsdName"),
    ("BSD-2-Clause", "AllRights? BsdGrant BsdSource BsdBinary"),
    ("GPL-3.0-or-later", "GplFree | GplTerms GplLater3"),
    ("GPL-2.0-or-later", "GplTerms GplLater2"),
    ("LGPL-3.0-or-later", "LgplTerms GplLater3"),
    ("LGPL-2.1-or-later", "LgplTerms LgplLater21"),
    ("LGPL-2.0-or-later", "LibraryTerms GplLater2"),
    ("AGPL-3.0-or-later", "AgplTerms GplLater3"),
    ("GPL-3.0", "GplRef3"),
    ("GPL-2.0", "GplRef2"),
    ("LGPL-3.0", "LgplRef3"),
    ("AGPL-3.0", "AgplRef3"),
    ("MPL-2.0", "Mpl2Ref | Mpl2Terms"),
    ("CC-BY-NC-4.0", "CcByNc4"),
    ("CC-BY-SA-4.0", "CcBySa4"),
    ("CC-BY-ND-4.0", "CcByNd4"),
    ("CC-BY-4.0", "CcBy4"),
    ("CC0-1.0", "Cc0"),
    ("ISC", "AllRights? IscGrant MitAsIs?"),
    ("Unlicense", "Unlicense"),
    ("Apache-2.0", "ApacheTitle ApacheAsIs?"),
    ("BSD", "BsdRef | BsdGrant BsdSource | BsdGrant"),
    ("MIT", "MitRef | MitTitle | MitGrant"),
    ("Proprietary", "AllRights"),
)


@dataclass(frozen=True)
class Knowledge:
    """Known sentences in normal form, ordered rules over their identifiers, and SPDX names.

    Identifiers ``Is:<licence>`` and ``Spdx:<licence>`` stand for that licence and need no rule.
    """

    sentences: tuple[tuple[str, str], ...] = SENTENCES
    rules: tuple[tuple[str, str], ...] = RULES
    hint: str = HINT
    names: tuple[tuple[str, str], ...] = tuple(spdx_names().items())

    def lookup(self) -> dict[str, str]:
        """Sentences and their identifiers; a sentence given by hand goes before a generated one."""
        return {s: name for name, s in (*standing_sentences(), *self.sentences)}

    def patterns(self) -> list[tuple[str, str]]:
        """What rules match in a sequence, and what they put there."""
        ruled = [(rule_pattern(rule), f"<{name}>") for name, rule in self.rules]
        return [*ruled, (r"\[(?:Is|Spdx):([^\]]+)\]", "<{}>")]


def normal(sentence: Column) -> Column:
    """Lower case of A-Z, runs of other characters as one blank, edges stripped."""
    lowered = F.translate(sentence, UPPER, LOWER)
    return F.regexp_replace(F.regexp_replace(lowered, OTHER, " "), EDGE, "")


def recognise(docs: DataFrame, text: str = "text", known: Knowledge = Knowledge()) -> DataFrame:
    """``docs`` with ``_ids``, the identifiers of its known sentences in order, and
    ``_sequence``, what the rules made of them: ``<name>`` for a licence, ``|id`` for the rest.
    """
    body = F.regexp_replace(text_or_empty(text), TAG, f"\n\n{MARK}$1\n\n")
    lookup = F.create_map(*[F.lit(v) for pair in known.lookup().items() for v in pair])
    names = F.create_map(*[F.lit(v) for name, licence in known.names for v in (name, f"Spdx:{licence}")])
    of = lambda sentence: F.element_at(lookup, normal(sentence))

    def named(part: Column) -> Column:
        return F.element_at(names, F.regexp_extract(F.translate(part, UPPER, LOWER), NAME, 1))

    def ids(piece: Column) -> Column:
        whole = of(piece)
        lines = F.transform(F.split(piece, "\n", -1), of)
        parts = F.split(F.substring(piece, len(MARK) + 1, 2**31 - 1), OPERATOR, -1)
        last = F.array_position(F.transform(parts, lambda part: part.rlike(BARE)), False).cast("int")
        expression = F.when(last > 0, F.slice(parts, 1, F.greatest(last, F.lit(1)))).otherwise(parts)
        return (
            F.when(F.startswith(piece, F.lit(MARK)), F.transform(expression, named))
            .when(whole.isNotNull(), F.array(whole))
            .otherwise(lines)
        )

    found = F.filter(
        F.flatten(F.transform(F.split(body, ENDS, -1), ids)), lambda name: name.isNotNull()
    )
    none = F.array().cast("array<string>")
    out = docs.withColumn("_ids", F.when(body.rlike(known.hint), found).otherwise(none))
    sequence = F.concat_ws("", F.transform("_ids", lambda name: F.concat(F.lit("["), name, F.lit("]"))))
    for pattern, put in known.patterns():
        sequence = F.regexp_replace(sequence, pattern, put.replace("{}", "$1"))
    return out.withColumn("_sequence", sequence)


def rule_pattern(rule: str) -> str:
    """The pattern of a rule over a sequence such as ``[MitTitle][MitGrant]``."""

    def one(term: str) -> str:
        return rf"(?:\[{term[:-1]}\])?" if term.endswith("?") else rf"\[{term}\]"

    return "|".join("".join(map(one, way.split())) for way in rule.split("|"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Licences in order, how many sentences were known, and those no rule used."""
    marks = lambda pattern: F.regexp_extract_all("_sequence", F.lit(pattern), F.lit(1))
    return found.select(
        key,
        F.array_join(marks("<([^>]+)>"), ",").alias("licenses"),
        F.size("_ids").cast("long").alias("n_sentences"),
        F.array_join(F.col("_ids"), ",").alias("sentences"),
        F.array_join(marks(r"\[([^\]]+)\]"), ",").alias("unmatched"),
    )


def digest_sql(known: Knowledge = Knowledge()) -> str:
    """The same in DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    def table(pairs) -> str:
        return f"map([{', '.join(quote(k) for k, _ in pairs)}], [{', '.join(quote(v) for _, v in pairs)}])"

    norm = (
        f"regexp_replace(regexp_replace(translate({{}}, '{UPPER}', '{LOWER}'), {quote(OTHER)}, ' ', 'g'),"
        f" {quote(EDGE)}, '', 'g')"
    )
    of = f"{table(known.lookup().items())}[{norm}]"
    named = (
        f"{table([(n, f'Spdx:{v}') for n, v in known.names])}"
        f"[regexp_extract(translate(q, '{UPPER}', '{LOWER}'), {quote(NAME)}, 1)]"
    )
    parts = f"regexp_split_to_array(substr(p, {len(MARK) + 1}), {quote(OPERATOR)})"
    last = f"list_position(list_transform({parts}, lambda q: regexp_matches(q, {quote(BARE)})), false)"
    expression = f"CASE WHEN coalesce({last}, 0) > 0 THEN ({parts})[1:{last}] ELSE {parts} END"
    sequence = "array_to_string(list_transform(ids, lambda x: '[' || x || ']'), '')"
    for pattern, put in known.patterns():
        replaced = quote(put.replace("{}", "\\1"))
        sequence = f"regexp_replace({sequence}, {quote(pattern)}, {replaced}, 'g')"
    return f"""
WITH found AS (
  SELECT doc_id, list_filter(flatten(list_transform(
      regexp_split_to_array(regexp_replace(coalesce(text, ''), {quote(TAG)},
        chr(10) || chr(10) || '{MARK}\\1' || chr(10) || chr(10), 'g'), {quote(ENDS)}),
      lambda p: CASE WHEN starts_with(p, '{MARK}')
        THEN list_transform({expression}, lambda q: {named})
        WHEN {of.format("p")} IS NOT NULL THEN [{of.format("p")}]
        ELSE list_transform(string_split(p, chr(10)), lambda q: {of.format("q")}) END)),
    lambda x: x IS NOT NULL) AS ids
  FROM documents),
ruled AS (SELECT doc_id, ids, {sequence} AS sequence FROM found)
SELECT doc_id,
  array_to_string(regexp_extract_all(sequence, '<([^>]+)>', 1), ',') AS licenses,
  len(ids) AS n_sentences,
  array_to_string(ids, ',') AS sentences,
  array_to_string(regexp_extract_all(sequence, '\\[([^\\]]+)\\]', 1), ',') AS unmatched
FROM ruled"""
