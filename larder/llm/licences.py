"""Licence scan by sentence rules.

Comment marks and list numbers are taken off the front of every line; the text is cut into sentences
at full stops and blank lines, so a sentence may go over many lines. A sentence is normalised (ASCII
lower case, runs of anything but a-z and 0-9 become one blank) and searched for known licence
sentences, the longest at each place, whole words only. The sequence of sentence identifiers, with a
gap for whatever isn't known, is matched against ordered rules: at each place the first rule whose
identifiers follow one another there is taken and consumed; a known sentence that no rule takes is
reported as UNKNOWN.

All in SQL functions, row by row, without a shuffle; no sentence is too long. Defined results: a null
or empty text has no sentence and no licence; a null doc_id stays null; repeated rows give a row
each; extra columns, whatever their names, are left out.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sentences of published licences and notices, under names of our own.
SENTENCES: dict[str, list[str]] = {
    "apache": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "copy-at": ["You may obtain a copy of the License at"],
    "apache-url": ["http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0"],
    "apache-unless": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'],
    "apache-see": ["See the License for the specific language governing permissions and limitations under the License"],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software"],
    "mit-warranty": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "mit-0-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-advert": ["All advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-name": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-warranty": ['THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED'],
    "bsd-liability": ["IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "isc-warranty": ['THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS'],
    "isc-liability": ["IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"],
    "gpl-3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl-2-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "gpl-2": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License"],
    "lgpl-2.1-later": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "lgpl-3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "agpl-3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"],
    "gnu-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "gpl-see": ["See the GNU General Public License for more details"],
    "lgpl-see": ["See the GNU Lesser General Public License for more details"],
    "agpl-see": ["See the GNU Affero General Public License for more details"],
    "gpl-received": ["You should have received a copy of the GNU General Public License along with this program"],
    "lgpl-received": ["You should have received a copy of the GNU Lesser General Public License along with this library", "You should have received a copy of the GNU Lesser General Public License along with this program"],
    "agpl-received": ["You should have received a copy of the GNU Affero General Public License along with this program"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    "mpl-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"],
    "epl-2": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which is available at http://www.eclipse.org/legal/epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "epl-1": ["All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"],
    "bsl": ["Distributed under the Boost Software License, Version 1.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "unlicense-anyone": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"],
    "cc0": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlib-liable": ["In no event will the authors be held liable for any damages arising from the use of this software"],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"],
    "wtfpl": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"],
    "reserved": ["All rights reserved"],
}
# Names of licences in notices, by identifier.
NAMES: dict[str, list[str]] = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 license"],
    "MIT": ["MIT License", "MIT licence"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "ISC": ["ISC License"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "Zlib": ["zlib License"],
    "Unlicense": ["Unlicense"],
    "GPL-2.0-or-later": [],
    "GPL-3.0-or-later": [],
    "LGPL-2.1-or-later": [],
    "LGPL-3.0-or-later": [],
    "AGPL-3.0-or-later": [],
}
VERBS, ARTICLES = ("licensed", "licenced", "released", "distributed", "published", "available"), ("", "the ", "a ", "the terms of the ")
#: Sentences that say of themselves which licence holds: verb, article and name, and the tag of a file.
SENTENCES |= {f"notice {x}": [f"{v} under {a}{n}" for v, a, n in product(VERBS, ARTICLES, names)] + [f"SPDX-License-Identifier: {x}"] for x, names in NAMES.items()}
# A licence and the sentences that follow one another in it; earlier rules go first.
RULES: list[tuple[str, str]] = [
    ("Apache-2.0", "apache apache-copy apache-unless apache-see"),
    ("Apache-2.0", "apache copy-at apache-url apache-unless apache-see"),
    ("Apache-2.0", "apache apache-unless apache-see"),
    ("Apache-2.0", "apache"),
    ("BSD-4-Clause", "bsd-grant bsd-source bsd-binary bsd-advert"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-name bsd-warranty bsd-liability"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-name bsd-warranty"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-name"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary bsd-warranty bsd-liability"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary bsd-warranty"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary"),
    ("MIT", "mit-grant mit-notice mit-warranty mit-liability"),
    ("MIT", "mit-grant mit-notice mit-warranty"),
    ("MIT", "mit-grant mit-notice"),
    ("MIT-0", "mit-0-grant mit-warranty mit-liability"),
    ("MIT-0", "mit-0-grant mit-warranty"),
    ("ISC", "isc-grant isc-warranty isc-liability"),
    ("ISC", "isc-grant isc-warranty"),
    ("ISC", "isc-grant"),
    ("0BSD", "0bsd-grant isc-warranty isc-liability"),
    ("0BSD", "0bsd-grant isc-warranty"),
    ("AGPL-3.0-or-later", "agpl-3-later gnu-hope agpl-see agpl-received"),
    ("AGPL-3.0-or-later", "agpl-3-later gnu-hope agpl-see"),
    ("AGPL-3.0-or-later", "agpl-3-later"),
    ("LGPL-3.0-or-later", "lgpl-3-later gnu-hope lgpl-see lgpl-received"),
    ("LGPL-3.0-or-later", "lgpl-3-later gnu-hope lgpl-see"),
    ("LGPL-3.0-or-later", "lgpl-3-later"),
    ("LGPL-2.1-or-later", "lgpl-2.1-later gnu-hope lgpl-see lgpl-received"),
    ("LGPL-2.1-or-later", "lgpl-2.1-later gnu-hope lgpl-see"),
    ("LGPL-2.1-or-later", "lgpl-2.1-later"),
    ("GPL-3.0-or-later", "gpl-3-later gnu-hope gpl-see gpl-received"),
    ("GPL-3.0-or-later", "gpl-3-later gnu-hope gpl-see"),
    ("GPL-3.0-or-later", "gpl-3-later"),
    ("GPL-2.0-or-later", "gpl-2-later gnu-hope gpl-see gpl-received"),
    ("GPL-2.0-or-later", "gpl-2-later gnu-hope gpl-see"),
    ("GPL-2.0-or-later", "gpl-2-later"),
    ("GPL-2.0-only", "gpl-2 gnu-hope gpl-see gpl-received"),
    ("GPL-2.0-only", "gpl-2 gnu-hope gpl-see"),
    ("GPL-2.0-only", "gpl-2"),
    ("MPL-2.0", "mpl mpl-copy"),
    ("MPL-2.0", "mpl"),
    ("EPL-2.0", "epl-2"),
    ("EPL-1.0", "epl-1"),
    ("BSL-1.0", "bsl"),
    ("Unlicense", "unlicense unlicense-anyone"),
    ("Unlicense", "unlicense"),
    ("CC0-1.0", "cc0"),
    ("Zlib", "zlib zlib-liable zlib-grant"),
    ("Zlib", "zlib-grant"),
    ("WTFPL", "wtfpl"),
    ("ALL-RIGHTS-RESERVED", "reserved"),
]
RULES += [(x, f"notice {x}".replace(" ", "_")) for x in NAMES]
NUMBERS = {name.replace(" ", "_"): i for i, name in enumerate(SENTENCES)}
#: Sentences that are part of a rule at most, never a finding by themselves.
SILENT = ("copy-at", "apache-url")
GAP = "."
#: What stands before the text of a line: marks of comments, then a list number or bullet.
_FRONT = r"(^|\n)[ \t]*(?:(?:/\*+|\*+/|\*+|//+!?|#+!?|--+>?|;+|%+|<!--+|>+)[ \t]*)*{}(?:(?:\(?(?:[0-9][0-9]?|[a-zA-Z])[.)]|[-•])[ \t]+)?"
_END = r"[.!?][)\"']*[ \t\r\n]+|{}[ \t\r]*\n[ \t\r]*\n\s*"
#: In Java the repeated marks are taken in a loop, without going back, so a line of any number of them needs no stack;
#: and a blank line is looked for from the first of a run of blanks only. The same matches, in linear time.
_JAVA_FRONT, _JAVA_END = _FRONT.format("+"), _END.format(r"(?<![ \t\r])")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every known sentence has one of these; others needn't be searched.
STEMS = ("licen", "reserved", "redistribut", "permission", "softwa", "apache", "mpl", "warrant", "under")


def normalise(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.translate(str.maketrans(_UPPER, _LOWER))).strip(" ")


def apart(normal: str) -> str:
    """Every word with a blank on each side of its own, so that neighbouring sentences share none."""
    return " " + normal.replace(" ", "  ") + " "


def _known() -> dict[str, str]:
    """The identifier of each known sentence, its words apart; of equal ones the first's."""
    found: dict[str, str] = {}
    for name, all_ in SENTENCES.items():
        for s in all_:
            found.setdefault(apart(normalise(s)), f"<{NUMBERS[name.replace(' ', '_')]}>")
    assert all(any(x in k for x in STEMS) for k in found)
    return found


def _sentence_pattern() -> str:
    """A pattern of all known sentences, as a tree of words: the longest of those that begin alike is tried first."""
    tree: dict = {}
    for key in _known():
        node = tree
        for word in key.split():
            node = node.setdefault(word, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        own = [f" {w} {pattern(x)}" for w, x in sorted(node.items()) if w]
        if not own:
            return ""
        return own[0] if len(own) == 1 and "" not in node else "(?:" + "|".join(own) + ("|" if "" in node else "") + ")"

    return f"({pattern(tree)})"


def _rules() -> dict[str, str]:
    """The licence of each sequence of identifiers, earlier rules first."""
    found: dict[str, str] = {}
    for licence, names in RULES:
        found.setdefault("".join(f"<{NUMBERS[n]}>" for n in names.split()), licence)
    return found


def _rule_pattern() -> str:
    silent = {f"<{NUMBERS[n]}>" for n in SILENT}
    return "(" + "|".join([*_rules(), *(f"<{i}>" for i in NUMBERS.values() if f"<{i}>" not in silent)]) + ")"


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_sentences, n_known, found): ``found`` lists (licence, sentence identifiers) in the order of the text."""
    table = F.create_map(*[F.lit(x) for kv in _known().items() for x in kv])
    name = F.create_map(*[F.lit(x) for kv in _rules().items() for x in kv])

    def normal(c: Column) -> Column:
        words = F.trim(F.regexp_replace(F.translate(c, _UPPER, _LOWER), "[^a-z0-9]+", " "))
        return F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))

    def likely(c: Column) -> Column:
        low, found = F.lower(c), F.lit(False)
        for stem in STEMS:
            found |= low.contains(stem)
        return found

    def identified(c: Column) -> Column:
        """Identifiers of the known sentences in a normalised one, with gaps for the words before, between and after them."""
        found = F.regexp_extract_all(c, F.lit(_sentence_pattern()), 1)
        gapless = F.aggregate(found, F.lit(0), lambda s, x: s + F.char_length(x)) == F.char_length(c)
        ids = F.array_join(F.transform(found, lambda x: table[x]), "")
        gaps = F.array_join(F.transform(found, lambda x: table[x]), GAP)
        before, after = F.when(F.startswith(c, F.element_at(found, 1)), "").otherwise(GAP), F.when(F.endswith(c, F.element_at(found, -1)), "").otherwise(GAP)
        return F.when(F.size(found) == 0, GAP).when(gapless, ids).otherwise(F.concat(before, gaps, after))

    # the full stop at the very end goes by normalising
    lines = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _JAVA_FRONT, "$1")
    sentences = F.filter(F.split(lines, _JAVA_END), lambda s: s != "")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.transform(sentences, lambda s: F.when(likely(s), normal(s))).alias("sentences"))
    ids = F.transform("sentences", lambda s: F.when(s.isNull(), GAP).otherwise(identified(s)))
    rows = rows.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join(ids, "").alias("ids"))
    numbers = lambda m: F.transform(F.filter(F.split(m, "[<>]+"), lambda x: x != ""), lambda x: x.cast("int"))
    found = F.transform(F.regexp_extract_all("ids", F.lit(_rule_pattern()), 1), lambda m: F.struct(F.coalesce(name[m], F.lit("UNKNOWN")).alias("licence"), numbers(m).alias("sentences")))
    return rows.select("doc_id", "n_sentences", F.regexp_count("ids", F.lit("<")).cast("long").alias("n_known"), found.alias("found"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["licence"]))), ",")
    return found.select("doc_id", "n_sentences", "n_known", F.size("found").cast("long").alias("n_found"), names.alias("licences"))


def _sql() -> str:
    quote = "'{}'".format
    table = "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in _known().items()) + "}"
    name = "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in _rules().items()) + "}"
    end, front = _END.format("").replace("'", "''"), _FRONT.format("").replace("'", "''")
    return f"""
WITH k AS (SELECT {table} AS t, {name} AS r),
s AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '{front}', '\\1', 'g'), '{end}'), lambda x: x <> '') AS s FROM documents),
u AS (SELECT row_number() OVER () AS n, doc_id, s FROM s),
e AS (SELECT n, i, ' ' || replace(trim(regexp_replace(translate(x, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ', '  ') || ' ' AS c FROM (SELECT n, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM u)),
f AS (SELECT n, i, c, regexp_extract_all(c, '{_sentence_pattern()}') AS f FROM e WHERE regexp_matches(c, '{"|".join(STEMS)}')),
o AS (SELECT n, i, CASE WHEN length(array_to_string(f, '')) = length(c) THEN array_to_string(list_transform(f, lambda x: t[x]), '')
                        ELSE CASE WHEN starts_with(c, f[1]) THEN '' ELSE '{GAP}' END || array_to_string(list_transform(f, lambda x: t[x]), '{GAP}') || CASE WHEN ends_with(c, f[-1]) THEN '' ELSE '{GAP}' END END AS id
      FROM f, k WHERE len(f) > 0),
q AS (SELECT n, string_agg(coalesce(id, '{GAP}'), '' ORDER BY i) AS ids FROM e LEFT JOIN o USING (n, i) GROUP BY n),
g AS (SELECT u.doc_id, len(s) AS n_sentences, coalesce(ids, '') AS ids, regexp_extract_all(coalesce(ids, ''), '{_rule_pattern()}') AS found FROM u LEFT JOIN q USING (n))
SELECT doc_id, cast(n_sentences AS BIGINT) AS n_sentences, cast(length(ids) - length(replace(ids, '<', '')) AS BIGINT) AS n_known, cast(len(found) AS BIGINT) AS n_found,
       array_to_string(list_sort(list_distinct(list_transform(found, lambda x: coalesce(r[x], 'UNKNOWN')))), ',') AS licences
FROM g, k
"""


OP4_SQL = _sql()
