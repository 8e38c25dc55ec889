"""Licence recognition by sentences.

Texts without a word that licences are told by are not looked at further.
A text is cut into sentences, three times: line by line, with line breaks read as spaces (notices are often
wrapped), and paragraph by paragraph, where a sentence also ends at a blank line and each of its lines counts
besides the whole. Each sentence is normalised and, where it is a known licence sentence, replaced by its
identifier. A licence is recognised where the identifiers of one of these views contain those of one of its rules
in the rule's order; other sentences may stand between. Everything is a DataFrame expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known licence sentences in normal form (lower case; every run of other characters than a-z, 0-9 is one space).
SENTENCES = {
    "mit_name": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_title": "the mit license mit",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache_name": "licensed under the apache license version 2 0",
    "apache_head": "licensed under the apache license version 2 0 the license",
    "apache_copy": "you may obtain a copy of the license at",
    "apache_as_is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3_name": "this work is licensed under the gnu general public license version 3",
    "gpl_free": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl_details": "see the gnu general public license for more details",
    "gpl_received": "you should have received a copy of the gnu general public license along with this program",
    "gpl_terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl2_terms": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3_terms": "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "lgpl_terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "agpl_terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "later_2": "either version 2 of the license or at your option any later version",
    "later_21": "either version 2 1 of the license or at your option any later version",
    "later_3": "either version 3 of the license or at your option any later version",
    "lgpl_free": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2_form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2_copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mpl2_copy_http": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "agpl3_free": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl3_free": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "epl2_available": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc_grant_and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "zero_bsd_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "author_disclaims": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "zlib_as_is": "this software is provided as is without any express or implied warranty",
    "zlib_grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlib_origin": "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    "boost_notice": "distributed under the boost software license version 1 0",
    "boost_grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "cc_by_nc_4": "licensed under cc by nc 4 0",
    "cc_by_4": "licensed under cc by 4 0",
    "cc_by_sa_4": "licensed under cc by sa 4 0",
    "cc_by_sa_work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc_by_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0_work": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense_public": "this is free and unencumbered software released into the public domain",
    "rights_reserved": "all rights reserved",
}

#: names of licences in normal form; a sentence that names one by one of NAMING_SENTENCES has the identifier before it
NAMES = {
    "mit_named": ["mit license"],
    "apache_named": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"],
    "gpl2_named": ["gnu general public license version 2", "gnu general public license version 2 only", "general public license version 2", "general public license version 2 only", "gnu general public license v2 0", "gplv2", "gpl v2", "gnu gpl v2", "gnu gpl version 2"],
    "gpl3_named": ["gnu general public license version 3", "gnu general public license version 3 only", "general public license version 3", "general public license version 3 only", "gnu general public license v3 0", "gplv3", "gpl v3", "gnu gpl v3", "gnu gpl version 3"],
    "agpl3_named": ["gnu affero general public license version 3", "gnu affero general public license v3 0", "agplv3", "agpl v3", "gnu agpl v3", "gnu agpl version 3"],
    "lgpl21_named": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgplv2 1", "lgpl v2 1", "gnu lgpl v2 1", "gnu lgpl version 2 1"],
    "lgpl3_named": ["gnu lesser general public license version 3", "gnu lesser general public license v3 0", "lgplv3", "lgpl v3", "gnu lgpl v3", "gnu lgpl version 3"],
    "bsd2_named": ["bsd 2 clause license", "simplified bsd license"],
    "bsd3_named": ["bsd 3 clause license", "new bsd license"],
    "isc_named": ["isc license"],
    "zlib_named": ["zlib license"],
    "boost_named": ["boost software license version 1 0"],
    "mpl2_named": ["mozilla public license version 2 0", "mozilla public license 2 0"],
    "epl2_named": ["eclipse public license version 2 0", "eclipse public license 2 0"],
    "cc_by_named": ["creative commons attribution 4 0 international license"],
    "cc_by_sa_named": ["creative commons attribution sharealike 4 0 international license"],
    "cc_by_nc_named": ["creative commons attribution noncommercial 4 0 international license"],
    "cc_by_nd_named": ["creative commons attribution noderivatives 4 0 international license"],
    "cc_by_nc_sa_named": ["creative commons attribution noncommercial sharealike 4 0 international license"],
    "cc_by_nc_nd_named": ["creative commons attribution noncommercial noderivatives 4 0 international license"],
}
NAMING_SENTENCES = ("licensed under {}", "released under {}", "distributed under {}", "made available under {}")
_SHORT = {"cc_by_nc_sa_4": "cc by nc sa 4 0", "cc_by_nd_4": "cc by nd 4 0", "cc_by_nc_nd_4": "cc by nc nd 4 0"}
#: what stands before an identifier of a licence list
LABELS = ("spdx license identifier", "license", "licence")
#: identifiers of the public licence list in normal form, by licence; each is a sentence of its own after a label
LISTED = {
    "MIT": ["mit"], "Apache-2.0": ["apache 2 0"], "GPL-2.0": ["gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later"], "GPL-3.0": ["gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later"], "LGPL-2.1": ["lgpl 2 1", "lgpl 2 1 only", "lgpl 2 1 or later"],
    "LGPL-3.0": ["lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later"], "AGPL-3.0": ["agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later"], "EPL-2.0": ["epl 2 0"], "ISC": ["isc"], "0BSD": ["0bsd"], "Zlib": ["zlib"], "BSL-1.0": ["bsl 1 0"],
    "BSD-2-Clause": ["bsd 2 clause"], "BSD-3-Clause": ["bsd 3 clause"], "MPL-2.0": ["mpl 2 0"], "CC-BY-4.0": ["cc by 4 0"], "CC-BY-SA-4.0": ["cc by sa 4 0"], "CC-BY-NC-4.0": ["cc by nc 4 0"], "CC0-1.0": ["cc0 1 0"], "Unlicense": ["unlicense"],
}
#: taken off a sentence in normal form: what is licensed, and where to read more
LEAD = r"^(this|the) (work|project|software|file|code|source code|library|program|package|repository) (is|are) (licensed|released|distributed|made available) under"
TAIL = r" see (the )?(license|licence|copying)( file| txt| md)?( for (more )?(details|information))?$"


def plain(sentence: str) -> str:
    """A sentence in normal form without lead and tail."""
    return re.sub(TAIL, "", re.sub(LEAD, r"\4 under", sentence))


def known_sentences() -> dict[str, str]:
    """Each known sentence and its identifier; a sentence listed by itself keeps its own."""
    made = {form.format(f"{article} {name}"): key for key, names in NAMES.items() for name in names for form in NAMING_SENTENCES for article in ("the", "a")}
    made |= {label: "label" for label in LABELS} | {text: f"listed_{k}" for k, texts in enumerate(LISTED.values()) for text in texts} | {f"{a} or {b}": "listed_mit_or_apache" for a, b in (("mit", "apache 2 0"), ("apache 2 0", "mit"))}
    return made | {f"licensed under {name}": key for key, name in _SHORT.items()} | {plain(text): key for key, text in SENTENCES.items()}


#: licence -> (class, rules); a rule lists sentences in their order. Rules of one licence are alternatives.
LICENCES: dict[str, tuple[str, list[list[str]]]] = {
    "MIT": ("permissive", [["mit_named"], ["mit_name"], ["mit_licensed"], ["mit_title", "mit_grant"], ["mit_grant", "mit_notice", "mit_as_is"]]),
    "Apache-2.0": ("permissive", [["apache_named"], ["apache_name"], ["apache_head", "apache_copy"], ["apache_head", "apache_as_is", "apache_see"]]),
    "GPL-3.0": ("copyleft", [["gpl3_named"], ["gpl3_name"], ["gpl_free"], ["gpl3_terms"], ["gpl_terms", "later_3"]]),
    "GPL-2.0": ("copyleft", [["gpl2_named"], ["gpl2_free"], ["gpl2_terms"], ["gpl_terms", "later_2"]]),
    "LGPL-2.1": ("copyleft", [["lgpl21_named"], ["lgpl_free"], ["lgpl_terms", "later_21"]]),
    "LGPL-3.0": ("copyleft", [["lgpl3_named"], ["lgpl3_free"], ["lgpl_terms", "later_3"]]),
    "AGPL-3.0": ("copyleft", [["agpl3_named"], ["agpl3_free"], ["agpl_terms", "later_3"]]),
    "EPL-2.0": ("copyleft", [["epl2_named"], ["epl2_available"]]),
    "ISC": ("permissive", [["isc_named"], ["isc_grant", "author_disclaims"], ["isc_grant_and", "author_disclaims"]]),
    "0BSD": ("permissive", [["zero_bsd_grant", "author_disclaims"]]),
    "Zlib": ("permissive", [["zlib_named"], ["zlib_as_is", "zlib_grant"], ["zlib_grant", "zlib_origin"]]),
    "BSL-1.0": ("permissive", [["boost_named"], ["boost_notice"], ["boost_grant"]]),
    "BSD-2-Clause": ("permissive", [["bsd2_named"], ["bsd_redistribution", "bsd_source", "bsd_binary"]]),
    "BSD-3-Clause": ("permissive", [["bsd3_named"], ["bsd_redistribution", "bsd_source", "bsd_binary", "bsd_endorse"]]),
    "MPL-2.0": ("copyleft", [["mpl2_named"], ["mpl2_form"], ["mpl2_copy"], ["mpl2_copy_http"]]),
    "CC-BY-NC-4.0": ("noncommercial", [["cc_by_nc_named"], ["cc_by_nc_4"]]),
    "CC-BY-NC-SA-4.0": ("noncommercial", [["cc_by_nc_sa_named"], ["cc_by_nc_sa_4"]]),
    "CC-BY-NC-ND-4.0": ("noncommercial", [["cc_by_nc_nd_named"], ["cc_by_nc_nd_4"]]),
    "CC-BY-ND-4.0": ("noderivatives", [["cc_by_nd_named"], ["cc_by_nd_4"]]),
    "CC-BY-4.0": ("permissive", [["cc_by_named"], ["cc_by_4"], ["cc_by_work"]]),
    "CC-BY-SA-4.0": ("copyleft", [["cc_by_sa_named"], ["cc_by_sa_4"], ["cc_by_sa_work"]]),
    "CC0-1.0": ("permissive", [["cc0_work"]]),
    "Unlicense": ("permissive", [["unlicense_public"]]),
    "All-Rights-Reserved": ("proprietary", [["rights_reserved"]]),
}

for _k, _name in enumerate(LISTED):
    LICENCES[_name][1].append(["label", f"listed_{_k}"])
for _name in ("MIT", "Apache-2.0"):
    LICENCES[_name][1].append(["label", "listed_mit_or_apache"])
#: a longer licence suppresses the shorter one that its rule holds; all rights reserved counts where nothing is granted
SUPPRESSED = {"BSD-2-Clause": ["BSD-3-Clause"], "All-Rights-Reserved": [name for name in LICENCES if name != "All-Rights-Reserved"]}

#: a sentence ends at . ! ? : or ; before white space (so that 2.0 stays whole), or at the end
_END = r"[.!?:;]+[ \t\r\f\x0B]+"
#: the same where line breaks are white space, or lines without a letter or digit (blank, or a comment's margin alone)
_END_WRAPPED = r"\n[^\p{L}\p{N}]*\n|[.!?:;]+[ \t\r\f\x0B\n]+"


#: every text with a licence has one of these, and every known sentence but those of LISTED
TELLING = r"(?i)licen|gpl|rights|permi|redist|copyright|warrant|software|copy"
_SHORTEST = {t.split()[0] for texts in LISTED.values() for t in texts}
#: every known sentence has one of these, before it is normalised as well
TELLING_SENTENCE = TELLING + "|" + "|".join(sorted(rf"\b{x}\b" for x in _SHORTEST))


def _telling(sentences: Column) -> Column:
    """Those of an array that may be known, by words of which each known sentence has one."""
    return F.filter(sentences, lambda s: (F.length(s) >= min(map(len, known_sentences()))) & s.rlike(TELLING_SENTENCE))


def _known(sentences: Column) -> Column:
    known = F.create_map(*(F.lit(x) for sentence in known_sentences().items() for x in sentence))
    normal = F.transform(_telling(sentences), lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    normal = F.transform(normal, lambda s: F.regexp_replace(F.regexp_replace(s, LEAD, "$4 under"), TAIL, ""))
    return F.filter(F.transform(normal, lambda s: F.try_element_at(known, s)), lambda k: k.isNotNull())


def _identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text without line breaks, in order; others are left out."""
    return _known(F.split(text, _END))


def _by_paragraph(text: Column) -> Column:
    """Identifiers of wrapped sentences, which end at blank lines too, each followed by those of its lines."""
    return F.flatten(F.transform(_telling(F.split(text, _END_WRAPPED)), lambda s: _known(F.concat(F.array(s), F.split(s, "\n")))))


def recognise(docs: DataFrame) -> DataFrame:
    """doc_id, sentences (identifiers, line by line), licences and classes (sorted, without repeats).

    Null and empty texts have none. A rule repeated or nested in a text counts once; a licence whose rule
    contains another's (BSD 3 and 2 clauses) suppresses the shorter, and any licence the reservation of all rights. Rows that repeat are each reported; extra
    columns are ignored; an empty table gives no rows. Sentences of any length are read.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).select("doc_id", F.when(F.col("text").rlike(TELLING), F.col("text")).otherwise("").alias("text"))
    text = F.col("text")
    by_line = F.flatten(F.transform(F.split(text, "\n"), _identifiers))
    wrapped = _identifiers(F.regexp_replace(text, "\n", " "))
    views = docs.select(F.col("doc_id"), by_line.alias("sentences"), wrapped.alias("wrapped"), _by_paragraph(text).alias("merged"))
    joined = lambda c: F.concat(F.lit(","), F.array_join(c, ","), F.lit(","))
    views = views.withColumn("seqs", F.array(joined("sentences"), joined("wrapped"), joined("merged")))

    def has(rules: list[list[str]]) -> Column:
        pattern = "|".join(",(?:[a-z0-9_]+,)*?".join(rule) for rule in rules)
        return F.exists("seqs", lambda s: s.rlike(f",(?:{pattern}),"))

    names = F.filter(F.array(*(F.when(has(rules), F.lit(name)) for name, (_, rules) in LICENCES.items())), lambda x: x.isNotNull())
    found = views.withColumn("licences", F.array_sort(names))
    for name, by in SUPPRESSED.items():
        found = found.withColumn("licences", F.when(F.arrays_overlap("licences", F.array(*map(F.lit, by))), F.array_remove("licences", name)).otherwise(F.col("licences")))
    kinds = F.create_map(*(F.lit(x) for name, (kind, _) in LICENCES.items() for x in (name, kind)))
    return found.select("doc_id", "sentences", "licences", F.array_sort(F.array_distinct(F.transform("licences", lambda n: F.element_at(kinds, n)))).alias("classes"))
