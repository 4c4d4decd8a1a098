"""Licence recognition by sentences, in DataFrame functions alone.

A text is written as lower-case words with signs between them: a blank, or a boundary where a sentence may begin or end. Known
sentences are found from boundary to boundary; a line end, a colon or a semicolon may also stand inside one, so that wrapped
texts are read, and a list number before one is left out. Identifiers are written as one sign each, unknown parts as a
dot, and the sequence is matched against ordered rules: the longest rule that starts at a sentence wins, and matching
goes on behind it. Everything happens where the text lies, without a shuffle.

Edge cases: null or empty text has no sentences; a known sentence that repeats is found as often as it stands; of rules
that start at one sentence the longest wins, of equally long ones the first; of sentences that start together the longest;
repeated rows and null doc_id are kept as rows; texts are read whole, in time that grows with their length (no pattern
looks back over what it has read); extra columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sentences of public licence texts and notices, by name.
SENTENCES = {
    "apache2": "Licensed under the Apache License, Version 2.0.",
    "apache2_the": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2_may_not": "you may not use this file except in compliance with the License.",
    "apache2_obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2_unless": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache2_see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit_released": "Released under the MIT License.",
    "mit_licensed": "Licensed under the MIT License.",
    "mit_name": "MIT License",
    "mit_permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit_warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "gpl3": "This work is licensed under the GNU General Public License, version 3.",
    "gpl_free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl_see": "See the GNU General Public License for more details.",
    "cc_by_nc4": "Licensed under CC BY-NC 4.0.",
    "cc_by4": "Licensed under CC BY 4.0.",
    "cc_by_sa4": "Licensed under CC BY-SA 4.0.",
    "cc_by4_work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc_by_nc4_work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "bsd_redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd_endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "spdx_mit": "SPDX-License-Identifier: MIT",
    "spdx_apache2": "SPDX-License-Identifier: Apache-2.0",
    "spdx_gpl3": "SPDX-License-Identifier: GPL-3.0-only",
}
#: Ordered sentences and the licence that they show.
RULES = (
    (("apache2_the", "apache2_may_not", "apache2_obtain", "apache2_unless", "apache2_see"), "Apache-2.0"),
    (("apache2_the", "apache2_may_not"), "Apache-2.0"),
    (("apache2",), "Apache-2.0"),
    (("mit_name", "mit_permission", "mit_notice", "mit_warranty"), "MIT"),
    (("mit_permission", "mit_notice", "mit_warranty"), "MIT"),
    (("mit_permission", "mit_notice"), "MIT"),
    (("mit_released",), "MIT"),
    (("mit_licensed",), "MIT"),
    (("mit_name",), "MIT"),
    (("gpl_free", "gpl_hope", "gpl_see"), "GPL-3.0-or-later"),
    (("gpl_free",), "GPL-3.0-or-later"),
    (("gpl3",), "GPL-3.0"),
    (("cc_by_nc4",), "CC-BY-NC-4.0"),
    (("cc_by_nc4_work",), "CC-BY-NC-4.0"),
    (("cc_by4",), "CC-BY-4.0"),
    (("cc_by4_work",), "CC-BY-4.0"),
    (("cc_by_sa4",), "CC-BY-SA-4.0"),
    (("bsd_redistribution", "bsd_source", "bsd_binary", "bsd_endorse"), "BSD-3-Clause"),
    (("bsd_redistribution", "bsd_source", "bsd_binary"), "BSD-2-Clause"),
    (("spdx_mit",), "MIT"),
    (("spdx_apache2",), "Apache-2.0"),
    (("spdx_gpl3",), "GPL-3.0"),
)
#: Boundaries, as capitals, which lower-case text doesn't have: end mark (H), line before a blank one (P), line end, colon or semicolon (S).
BOUNDARIES = (
    (r"[.!?][\s*/#>|-]++", "H"),
    (r"\n[*/#>|\x20\t\r\f\x0B-]*+(?=\n)", "P"),
    (r"\n|[;:](?=[\s*/#>|-])|[)](?=\s)(?<=[\nH;:][\s*/#>|-]{0,9}[(]?[0-9a-z]{1,2}[)])", "S"),
    (r"[^a-z0-9HPS]++", " "),
    (r" ?([HPS]) ?", "$1"),
)
NUMBER = r"(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})"


def normalised(sentence: str) -> str:
    return " ".join(re.findall(r"[a-z0-9]+", sentence.lower()))


def _signs(sentences: dict[str, str]) -> dict[str, str]:
    """A sign of its own for each sentence name, from the private use area."""
    return {name: chr(0xE000 + k) for k, name in enumerate(sentences)}


def _anywhere(sentence: str) -> str:
    """A pattern of the sentence over words and boundaries. Only addresses are set off by blank lines within sentences."""
    first, *rest = normalised(sentence).split()
    return first + "".join(("[ SP]+" if w == "http" else "[ S]+") + w for w in rest)


def recognise(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row for each row of docs: doc_id, n_known (known sentences), licenses (names in order, comma-joined), license_list, sequence."""
    signs = _signs(sentences)
    known = F.create_map(*[x for name, s in sentences.items() for x in (F.lit(normalised(s)), F.lit(signs[name]))])
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    pattern = "|".join("".join(signs[n] for n in names) for names, _ in ordered)
    shown = F.create_map(*[x for names, licence in ordered for x in (F.lit("".join(signs[n] for n in names)), F.lit(licence))])
    longest = sorted(sentences.values(), key=lambda s: -len(normalised(s)))
    part = f"(?:{NUMBER}[HPS]+)?({'|'.join(map(_anywhere, longest))})(?=[HPS])|[^HPS]++"
    text = F.concat(F.lit("\n"), F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit("\n"))
    for marks, sign in BOUNDARIES:
        text = F.regexp_replace(text, marks, sign)
    # Unknown parts come out empty; a dot stands for each.
    d = docs.select(F.col("doc_id").cast("long"), F.regexp_extract_all(text, F.lit(part), F.lit(1)).alias("parts"))
    each = F.transform("parts", lambda s: F.when(s == "", F.lit(".")).otherwise(F.coalesce(F.try_element_at(known, F.regexp_replace(s, "[ SP]+", " ")), F.lit("."))))
    d = d.select("doc_id", F.array_join(each, "").alias("sequence"))
    found = F.transform(F.regexp_extract_all("sequence", F.lit(pattern), F.lit(0)), lambda x: F.try_element_at(shown, x))
    d = d.select("doc_id", "sequence", found.alias("license_list"))
    n_known = F.length(F.replace(F.col("sequence"), F.lit("."), F.lit(""))).cast("long")
    return d.select("doc_id", n_known.alias("n_known"), F.array_join("license_list", ",").alias("licenses"), "license_list", "sequence")
