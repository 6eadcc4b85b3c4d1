"""Licences recognised by rules over known sentences."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from recordlake.llm.frames import annotate

# fixed values: sentences of public licence texts and notices, by identifier
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    'this software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in "
    "all copies or substantial portions of the Software.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
    "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-spdx": "SPDX-License-Identifier: Apache-2.0",
    "apache-grant": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not '
    "use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
    "CONDITIONS OF ANY KIND, either express or implied.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-spdx": "SPDX-License-Identifier: GPL-3.0-or-later",
    "gpl3-grant": "This program is free software: you can redistribute it and/or modify it under "
    "the terms of the GNU General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.",
    "gpl2-grant": "This program is free software; you can redistribute it and/or modify it under "
    "the terms of the GNU General Public License as published by the Free Software Foundation; "
    "either version 2 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT "
    "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may "
    "be used to endorse or promote products derived from this software without specific prior "
    "written permission.",
    "mpl-grant": "This Source Code Form is subject to the terms of the Mozilla Public License, "
    "v. 2.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc0-notice": "This work is licensed under CC0 1.0.",
}

# in order: a longer rule stands before one that it begins with
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-spdx",)),
    ("Apache-2.0", ("apache-grant", "apache-copy", "apache-warranty")),
    ("Apache-2.0", ("apache-grant", "apache-copy")),
    ("Apache-2.0", ("apache-grant",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-spdx",)),
    ("GPL-3.0-or-later", ("gpl3-grant", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl3-grant",)),
    ("GPL-3.0-or-later", ("gpl3-spdx",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-2.0-or-later", ("gpl2-grant", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
)

# the catalogue by licence: SPDX identifier, and the names that notices give it
NAMES = {
    "MIT": "MIT License|MIT licence|MIT|MIT/X11 License|Expat License|MIT License (MIT)",
    "MIT-0": "MIT No Attribution License|MIT-0 License|MIT-0",
    "Apache-2.0": "Apache License, Version 2.0|Apache License 2.0|Apache License v2.0|Apache License v2"
    "|Apache License Version 2|Apache 2.0 License|Apache 2.0|Apache 2 License|Apache-2.0 License"
    "|Apache Software License, Version 2.0|Apache Software License 2.0|Apache v2.0 License|Apache v2 License",
    "Apache-1.1": "Apache Software License, Version 1.1|Apache License, Version 1.1|Apache License 1.1",
    "BSD-3-Clause": "BSD 3-Clause License|3-Clause BSD License|BSD 3-Clause|New BSD License"
    "|Modified BSD License|Revised BSD License|three-clause BSD License|BSD 3-Clause New or Revised License",
    "BSD-2-Clause": "BSD 2-Clause License|2-Clause BSD License|BSD 2-Clause|Simplified BSD License"
    "|FreeBSD License|two-clause BSD License",
    "BSD-4-Clause": "BSD 4-Clause License|4-Clause BSD License|Original BSD License",
    "0BSD": "Zero-Clause BSD License|BSD Zero Clause License|0BSD License|0BSD",
    "ISC": "ISC License|ISC licence|ISC",
    "Unlicense": "Unlicense|Unlicense License",
    "Zlib": "zlib License|zlib/libpng License",
    "BSL-1.0": "Boost Software License, Version 1.0|Boost Software License 1.0|Boost Software License v1.0"
    "|Boost License 1.0|BSL-1.0",
    "MPL-2.0": "Mozilla Public License, Version 2.0|Mozilla Public License 2.0|Mozilla Public License v2.0"
    "|Mozilla Public License, v. 2.0|MPL 2.0|MPL-2.0|MPL v2.0|MPLv2|MPLv2.0",
    "MPL-1.1": "Mozilla Public License, Version 1.1|Mozilla Public License 1.1|MPL 1.1",
    "EPL-1.0": "Eclipse Public License, Version 1.0|Eclipse Public License 1.0|Eclipse Public License v1.0"
    "|Eclipse Public License - v 1.0|EPL 1.0|EPL-1.0",
    "EPL-2.0": "Eclipse Public License, Version 2.0|Eclipse Public License 2.0|Eclipse Public License v2.0"
    "|Eclipse Public License - v 2.0|EPL 2.0|EPL-2.0",
    "CDDL-1.0": "Common Development and Distribution License, Version 1.0|CDDL 1.0|CDDL-1.0"
    "|Common Development and Distribution License (CDDL) Version 1.0|Common Development and Distribution License 1.0",
    "EUPL-1.2": "European Union Public Licence, Version 1.2|European Union Public License 1.2|EUPL 1.2|EUPL-1.2"
    "|European Union Public Licence 1.2|European Union Public License, Version 1.2",
    "Artistic-2.0": "Artistic License 2.0|Artistic License, Version 2.0|Artistic-2.0",
    "OFL-1.1": "SIL Open Font License, Version 1.1|SIL Open Font License 1.1|Open Font License 1.1|OFL 1.1|OFL-1.1",
    "PSF-2.0": "Python Software Foundation License Version 2|PSF License Version 2|Python Software Foundation License 2.0",
    "WTFPL": "WTFPL|WTFPL License|Do What The Fuck You Want To Public License",
    "CC0-1.0": "CC0 1.0|CC0 1.0 Universal|CC0-1.0|Creative Commons Zero v1.0 Universal|CC0"
    "|Creative Commons CC0 1.0 Universal|CC0 1.0 Universal Public Domain Dedication|CC0 License",
}
OTHER_SPDX = (
    "AFL-3.0 Artistic-1.0 BlueOak-1.0.0 BSD-3-Clause-Clear CECILL-2.1 CPL-1.0 CDDL-1.1 "
    "ECL-2.0 FTL HPND IJG IPL-1.0 LPPL-1.3c MS-PL MS-RL MulanPSL-2.0 NCSA NPL-1.1 ODbL-1.0 OpenSSL "
    "OSL-3.0 PHP-3.01 PostgreSQL Python-2.0 QPL-1.0 Ruby SSPL-1.0 BUSL-1.1 UPL-1.0 Vim W3C X11 ZPL-2.1 "
    "Elastic-2.0 EUPL-1.1 GFDL-1.2 GFDL-1.3 GFDL-1.2-only GFDL-1.2-or-later GFDL-1.3-only "
    "GFDL-1.3-or-later curl bzip2-1.0.6 Libpng TCL Unicode-DFS-2016 NTP"
).split()
GNU = {
    ("GPL", "2.0"): "General Public License",
    ("GPL", "3.0"): "General Public License",
    ("LGPL", "2.0"): "Library General Public License",
    ("LGPL", "2.1"): "Lesser General Public License",
    ("LGPL", "3.0"): "Lesser General Public License",
    ("AGPL", "3.0"): "Affero General Public License",
}
CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
# what stands before a licence's name in a notice
LEADS = tuple(
    f"{verb} under{terms}{article}"
    for verb in "licensed released distributed published provided available".split()
    for terms in ("", " terms of", " the terms of", " the terms and conditions of", " the conditions of")
    for article in ("", " the", " a", " an")
)
# (licence, sentence of its text); the licences of two sentences alike are told apart by others
BODIES = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby "
     "grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
     "copyright license to reproduce, prepare Derivative Works of, publicly display, publicly "
     "perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("Apache-2.0", '"License" shall mean the terms and conditions for use, reproduction, and '
     "distribution as defined by Sections 1 through 9 of this document."),
    ("GPL-3.0-only", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0-only", "The GNU General Public License is a free, copyleft license for software and "
     "other kinds of works."),
    ("GPL-2.0-only", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0-only", "This License applies to any program or other work which contains a notice "
     "placed by the copyright holder saying it may be distributed under the terms of this General Public License."),
    ("LGPL-3.0-only", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0-only", "This version of the GNU Lesser General Public License incorporates the terms "
     "and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("LGPL-2.1-only", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-2.0-only", "GNU Library General Public License Version 2, June 1991"),
    ("AGPL-3.0-only", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0-only", "The GNU Affero General Public License is a free, copyleft license for software "
     "and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", '"Covered Software" means Source Code Form to which the initial Contributor has '
     "attached the notice in Exhibit A, the Executable Form of such Source Code Form, and "
     "Modifications of such Source Code Form, in each case including portions thereof. "
     '1.5. "Incompatible With Secondary Licenses" means'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event "
     "will the authors be held liable for any damages arising from the use of this software."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining "
     "a copy of the software and accompanying documentation covered by this license (the \"Software\") "
     "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
     "derivative works of the Software, and to permit third-parties to whom the Software is furnished "
     "to do so, all subject to the following:"),
    ("EPL-1.0", 'THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT").'),
    ("EPL-2.0", "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE "
     '("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT\'S '
     "ACCEPTANCE OF THIS AGREEMENT. 1. DEFINITIONS \"Contribution\" means: a) in the case of the initial "
     "Contributor, the initial content"),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004"),
)


def catalogue() -> tuple[dict[str, str], tuple, dict[str, str]]:
    """Sentences and rules of all licences, those above first; and licences by name for notices."""
    names = {licence: spelt.split("|") for licence, spelt in NAMES.items()}
    grants = []
    for (short, version), long in GNU.items():
        v = version.removesuffix(".0")
        only, later = f"{short}-{version}-only", f"{short}-{version}-or-later"
        plain = [
            f"{prefix}{long}{acronym}{mark}{number}"
            for prefix in ("GNU ", "")
            for acronym in ("", f" ({short})")
            for mark in (" version ", ", version ", " v", " ")
            for number in {v, version}
        ]
        plain += [f"{g}{short}{mark}{n}" for g in ("", "GNU ") for mark in (" ", "v", " v", " version ") for n in {v, version}]
        names[only] = [*plain, *[f"{p} only" for p in plain], *[f"{p} License" for p in plain]]
        names[later] = [f"{p} {tail}" for p in plain for tail in ("or later", "or any later version", "or (at your option) any later version")]
        for what in ("program", "library", "software", "file"):
            terms = f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {long}"
            by = "as published by the Free Software Foundation"
            for number in {v, version}:
                for either in ("either ", ""):
                    tail = f"{by}, {either}version {number} of the License"
                    grants.append((later, f"{terms} {tail}, or (at your option) any later version."))
                    grants.append((only, f"{terms} {tail}."))
                grants.append((only, f"{terms} version {number} {by}."))
    for part, long in CC.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            full = f"Creative Commons {long} {version}"
            full = [full, full.replace("NonCommercial", "Non-Commercial").replace("ShareAlike", "Share Alike").replace("NoDerivatives", "NoDerivs")]
            tails = ("", " International", " Unported", " Generic", " License", " International License", " Unported License", " Generic License")
            spelt = [f + t for f in full for t in tails] + [f"CC {part} {version}", f"CC {part} {version} License", f"Creative Commons {part} {version}"]
            names[f"CC-{part}-{version}"] = spelt
    sentences, rules = dict(SENTENCES), list(RULES)
    known = {normalised(x) for x in sentences.values()}

    def add(licence: str, name: str, sentence: str) -> None:
        words = normalised(sentence)
        if words not in known:
            known.add(words)
            sentences[name] = sentence
            rules.append((licence, (name,)))

    gnu_old = [f"{short}-{version}" for short, version in GNU]
    for licence in (*names, *gnu_old, *OTHER_SPDX):
        # identifiers without "only" or "or later" stand for the first
        meant = f"{licence}-only" if licence in gnu_old else licence
        add(meant, f"{SPDX}{licence}", f"SPDX-License-Identifier: {licence}")
    for licence, sentence in (*BODIES, *grants):
        add(licence, f"{licence}-body-{len(sentences)}", sentence)
    notices: dict[str, str] = {}
    for licence, spelt in names.items():
        rules.append((licence, (f"{licence}{NAMED}",)))
        for k, name in enumerate(spelt):
            if "licen" in name.lower():
                add(licence, f"{licence}{TITLE}{k}", name)
            notices.setdefault(name, licence)
    return sentences, tuple(rules), notices


# every known sentence holds one of these, so other texts hold no sentence
ANCHORS = (
    b"licens", b"licenc", b"permission", b"redistribut", b"warrant", b"released", b"distributed",
    b"published", b"provided", b"available", b"mozilla.org", b"unencumbered",
)
SPDX, TITLE, NAMED = "spdx-", "-title-", "-named"
WORD = re.compile(r"[a-z0-9]+")
END = re.compile(r"""["')\]]*[.!?:]?""")
FIELDS = {"n_sentences": "bigint", "sentence_ids": "string", "licenses": "string", "spans": "string"}


def normalised(text: str) -> tuple[str, ...]:
    """Words of a sentence: A-Z lower-cased, letters and digits only."""
    return tuple(WORD.findall(text.lower()))


def trie(entries) -> dict:
    """Nested dicts by word; the entry's value stands under the empty word."""
    top: dict = {}
    for sentence, value in entries:
        node = top
        for word in normalised(sentence):
            node = node.setdefault(word, {})
        node[""] = value
    return top


class Recognizer:
    """Known sentences in a text, and the licences whose rules they meet."""

    def __init__(self, sentences: dict[str, str], rules, notices: dict[str, str]):
        self.trie = trie((sentence, name) for name, sentence in sentences.items())
        # a notice is a lead and then a licence's name
        self.leads = trie((lead, lead) for lead in LEADS)
        self.names = trie((name, f"{licence}{NAMED}") for name, licence in notices.items())
        spdx = self.trie.get("spdx", {}).get("license", {}).get("identifier", {})
        self.identifiers = spdx
        self.sentence_names = set(sentences)
        self.rules: dict[str, list] = {}
        for licence, rule in rules:
            self.rules.setdefault(rule[0], []).append((licence, tuple(rule)))

    def longest(self, node: dict, words: list, at: int) -> tuple[str, int] | None:
        """The longest known sequence of words from ``at`` on, and where it ends."""
        best = None
        while at < len(words) and (node := node.get(words[at][0])) is not None:
            at += 1
            if "" in node:
                best = node[""], at
        return best

    def best(self, words: list, at: int) -> tuple[str, int] | None:
        """The longest known sentence or notice from ``at`` on, and where it ends."""
        best = self.longest(self.trie, words, at) if words[at][0] in self.trie else None
        node = self.leads
        while at < len(words) and (node := node.get(words[at][0])) is not None:
            at += 1
            if "" in node:
                named = self.longest(self.names, words, at)
                if named and (best is None or named[1] > best[1]):
                    best = named
        return best

    def whole(self, text: str, name: str, end: int) -> str | None:
        """The sentence's name if an SPDX identifier ends there; with + it is that or later."""
        after = text[end : end + 2]
        if after[:1] == "+":
            later = f"{name.removesuffix('-only').removesuffix('-or-later')}-or-later"
            return later if later in self.sentence_names else None
        cut = after[:1] in ("-", "_") or (after[:1] == "." and after[1:].isalnum())
        return None if cut else name

    def sentences(self, text: str) -> list[tuple[str, int, int]]:
        """(identifier, start, end) in order; of sentences from one place, the longest.

        Only words count, so a sentence may run over several lines, hold other
        marks, and stand anywhere. A bare title must be all the words of its
        line; after an SPDX identifier, more may follow by "or" and "and".
        """
        # lower-casing may lengthen other letters: A-Z alone are lower-cased, in place
        words = [(m[0], m.start(), m.end()) for m in WORD.finditer(text.translate(LOWER))]
        found, at = [], 0
        while at < len(words):
            best = self.best(words, at)
            if best and not self.fits(text, best[0], words[at][1], words[best[1] - 1][2]):
                best = None
            if not best:
                at += 1
                continue
            name, to = best
            start = words[at][1]
            while True:
                end = words[to - 1][2]
                if name.startswith(SPDX) or name.endswith("-spdx"):
                    name = self.whole(text, name, end)
                if name:
                    found.append((name, start, END.match(text, end).end()))
                spdx = not name or name.startswith(SPDX) or name.endswith("-spdx")
                more = spdx and to < len(words) and words[to][0] in ("or", "and")
                # the rest of an expression stands on the same line
                more = more and "\n" not in text[end : words[to][2]]
                following = self.longest(self.identifiers, words, to + 1) if more else None
                if not following:
                    break
                start = words[to + 1][1]
                name, to = following
            at = to
        return found

    def fits(self, text: str, name: str, start: int, end: int) -> bool:
        if TITLE not in name:
            return True
        line = text[text.rfind("\n", 0, start) + 1 : start]
        stop = text.find("\n", end)
        rest = text[end : stop if stop >= 0 else len(text)]
        before = WORD.sub("", line.lower()) == line.lower() or line.strip().lower() == "the"
        return before and not WORD.search(rest.lower())

    def licenses(self, found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """(licence, start, end): at each sentence, the first rule that the sequence meets.

        A title goes with the text of the same licence that follows it.
        """
        names = tuple(name for name, _, _ in found)
        met, at, titled = [], 0, -1
        while at < len(names):
            for licence, rule in self.rules.get(names[at], ()):
                if names[at : at + len(rule)] == rule:
                    start, end = found[at][1], found[at + len(rule) - 1][2]
                    if titled == at and met[-1][0] == licence:
                        start = met.pop()[1]
                    met.append((licence, start, end))
                    titled = at + 1 if TITLE in names[at] else -1
                    at += len(rule)
                    break
            else:
                at += 1
        return met


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
CATALOGUE, CATALOGUE_RULES, NOTICES = catalogue()


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    *,
    sentences: dict[str, str] = CATALOGUE,
    rules=CATALOGUE_RULES,
    notices: dict[str, str] = NOTICES,
    anchors: tuple[bytes, ...] = ANCHORS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Recognise licences in every whole text.

    Known are the ``sentences``, and notices: one of ``LEADS`` and then a name of
    ``notices``. ``sentence_ids`` lists the known sentences in order, ``licenses`` the
    licences of the rules they meet, ``spans`` these as
    ``licence:start:end`` in code points, end exclusive. Known sentences that
    meet no rule count in ``n_sentences`` alone. Each of ``sentences`` must
    hold one of ``anchors``, lower-cased; a text without any is not cut up.

    A null or empty text has none; rows are scanned one by one, so ties,
    repeated rows and empty tables need no special case. ``keep`` names the
    columns to carry (all if None); columns named like a result are replaced
    by it.
    """
    lacking = [n for n, s in sentences.items() if not any(a in s.lower().encode() for a in anchors)]
    if lacking:
        raise ValueError(f"sentences without an anchor: {lacking}")

    def make():
        recognizer = Recognizer(sentences, rules, notices)

        def row(value):
            raw = (value or "").encode("utf-8", "surrogatepass").lower()
            if not any(a in raw for a in anchors):
                return 0, "", "", ""
            found = recognizer.sentences(value)
            met = recognizer.licenses(found)
            return (
                len(found),
                ",".join(name for name, _, _ in found),
                ",".join(licence for licence, _, _ in met),
                ",".join(f"{licence}:{start}:{end}" for licence, start, end in met),
            )

        return row

    return annotate(df, make, FIELDS, [text], keep)
