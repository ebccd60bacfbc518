"""The signature rules of license scans, written by hand.

A rule is a line ``label | pattern`` in a section. Patterns are matched against a
text's words, lowered and joined by one space ("CC-BY-4.0" reads "cc by 4 0"), and
begin and end at word bounds. A rule's keywords are the plain words that every
match must hold, but for very common ones; it is tried only on texts that hold
them all. Sections go from the strongest evidence to the weakest: a section's
priority is its place from the end, and its confidence is stated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_SECTIONS = {
    # whole notices: sentences that only the license itself, or a file under it, holds
    ("notice", 1.0): r"""
mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | use copy modify merge publish distribute sublicense and or sell copies of the software
mit | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
hpnd | permission to use copy modify and distribute this software and its documentation for any purpose (?:and without fee )?is hereby granted
bsd | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | neither the names? of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-3-clause | the names? of (?:the )?(?:author|authors|contributors|copyright holders?) may not be used to endorse or promote products
bsd-4-clause | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-2-clause | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
apache-2.0 | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | apache license version 2 0 january 2004
apache-2.0 | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:except as stated in this section )?patent license
apache-1.1 | this product includes software developed by the apache software foundation
gpl-2.0-or-later | it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-3.0-or-later | it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl-2.0-only | under the terms of the gnu general public license (?:version 2 )?as published by the free software foundation version 2
gpl-3.0-only | under the terms of the gnu general public license (?:version 3 )?as published by the free software foundation version 3
gpl | you should have received a copy of the gnu general public license along with
gpl-3.0 | the gnu general public license is a free copyleft license for software
gpl-2.0 | the gnu general public license is intended to guarantee your freedom to share and change free software
lgpl-2.1-or-later | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
lgpl-3.0-or-later | under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
lgpl-2.0-or-later | under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
lgpl | you should have received a copy of the gnu lesser general public license along with
agpl-3.0-or-later | under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
agpl | you should have received a copy of the gnu affero general public license along with
gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
epl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?1 0
cddl-1.0 | the contents of this file are subject to the terms of the common development and distribution license
cc0-1.0 | to the extent possible under law (?:[^ ]+ ){1,12}has waived all copyright and related or neighboring rights
cc-by-4.0 | this work is licensed under (?:a|the) creative commons attribution 4 0 international (?:public )?license
cc-by-sa-4.0 | this work is licensed under (?:a|the) creative commons attribution sharealike 4 0 international (?:public )?license
cc-by-nc-4.0 | this work is licensed under (?:a|the) creative commons attribution noncommercial 4 0 international (?:public )?license
cc-by-nd-4.0 | this work is licensed under (?:a|the) creative commons attribution noderivatives 4 0 international (?:public )?license
cc-by-nc-sa-4.0 | this work is licensed under (?:a|the) creative commons attribution noncommercial sharealike 4 0 international (?:public )?license
cc-by-nc-nd-4.0 | this work is licensed under (?:a|the) creative commons attribution noncommercial noderivatives 4 0 international (?:public )?license
cc-by-3.0 | this work is licensed under (?:a|the) creative commons attribution 3 0 unported license
cc-by-sa-3.0 | this work is licensed under (?:a|the) creative commons attribution share ?alike 3 0 unported license
unlicense | this is free and unencumbered software released into the public domain
wtfpl | do what the fuck you want to public license
zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1.0 | boost software license version 1 0 august 17th 2003
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
artistic-2.0 | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes the terms under which a given free software package may be copied
artistic-1.0 | the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control
ofl-1.1 | this font software is licensed under the sil open font license version 1 1
ofl-1.1 | no modified version of the font software may use the reserved font names?
psf-2.0 | psf is making python available to licensee on an as is basis
python | cnri open source license agreement
openssl | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | this product includes cryptographic software written by eric young
php-3.01 | this product includes php software freely available from
ruby | you may make and give away verbatim copies of the source form of the software without restriction
postgresql | in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages
ncsa | university of illinois ncsa open source license
x11 | except as contained in this notice the name of the x consortium shall not be used in advertising
curl | copyright and permission notice copyright c (?:[^ ]+ ){1,6}daniel stenberg
beerware | if we meet some day and you think this stuff is worth it you can buy me a beer in return
json | the software shall be used for good not evil
ms-pl | microsoft public license ms pl this license governs use of the accompanying software
ms-rl | microsoft reciprocal license ms rl this license governs use of the accompanying software
eupl-1.2 | licensed under the eupl (?:version |v )?v?1 2
eupl-1.1 | licensed under the eupl (?:version |v )?v?1 1
cecill | this software is governed by the cecill (?:a |b |c )?license under french law
busl-1.1 | business source license 1 1
sspl-1.0 | server side public license version 1
elastic-2.0 | elastic license 2 0
commons-clause | commons clause license condition v ?1 0
upl-1.0 | the universal permissive license upl version 1 0
odbl-1.0 | open database license odbl v ?1 0
odc-by-1.0 | open data commons attribution license
pddl-1.0 | open data commons public domain dedication (?:and )?license
proprietary | unauthorized copying of this file via any medium is strictly prohibited
proprietary | this software is (?:the )?confidential and proprietary (?:information|property) of
""",
    # identifiers in the form machines read
    ("identifier", 0.98): r"""
mit | spdx license identifier mit
mit-0 | spdx license identifier mit 0
apache-2.0 | spdx license identifier apache 2 0
apache-1.1 | spdx license identifier apache 1 1
gpl-2.0-only | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | spdx license identifier gpl 2 0 or later
gpl-3.0-only | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | spdx license identifier gpl 3 0 or later
lgpl-2.1-only | spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later | spdx license identifier lgpl 2 1 or later
lgpl-3.0-only | spdx license identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later | spdx license identifier lgpl 3 0 or later
agpl-3.0-only | spdx license identifier agpl 3 0(?: only)?
agpl-3.0-or-later | spdx license identifier agpl 3 0 or later
bsd-2-clause | spdx license identifier bsd 2 clause
bsd-3-clause | spdx license identifier bsd 3 clause
bsd-4-clause | spdx license identifier bsd 4 clause
0bsd | spdx license identifier 0bsd
isc | spdx license identifier isc
mpl-2.0 | spdx license identifier mpl 2 0
mpl-1.1 | spdx license identifier mpl 1 1
epl-1.0 | spdx license identifier epl 1 0
epl-2.0 | spdx license identifier epl 2 0
cddl-1.0 | spdx license identifier cddl 1 0
cddl-1.1 | spdx license identifier cddl 1 1
cc0-1.0 | spdx license identifier cc0 1 0
cc-by-4.0 | spdx license identifier cc by 4 0
cc-by-3.0 | spdx license identifier cc by 3 0
cc-by-sa-4.0 | spdx license identifier cc by sa 4 0
cc-by-sa-3.0 | spdx license identifier cc by sa 3 0
cc-by-nc-4.0 | spdx license identifier cc by nc 4 0
cc-by-nc-sa-4.0 | spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 | spdx license identifier cc by nc nd 4 0
cc-by-nd-4.0 | spdx license identifier cc by nd 4 0
unlicense | spdx license identifier unlicense
wtfpl | spdx license identifier wtfpl
zlib | spdx license identifier zlib
bsl-1.0 | spdx license identifier bsl 1 0
busl-1.1 | spdx license identifier busl 1 1
artistic-2.0 | spdx license identifier artistic 2 0
ofl-1.1 | spdx license identifier ofl 1 1
psf-2.0 | spdx license identifier (?:psf|python) 2 0
postgresql | spdx license identifier postgresql
ncsa | spdx license identifier ncsa
x11 | spdx license identifier x11
ms-pl | spdx license identifier ms pl
eupl-1.2 | spdx license identifier eupl 1 2
sspl-1.0 | spdx license identifier sspl 1 0
elastic-2.0 | spdx license identifier elastic 2 0
proprietary | spdx license identifier licenseref proprietary
""",
    # places where a license is published
    ("address", 0.95): r"""
apache-2.0 | apache org licenses license 2 0
mit | opensource org licenses mit(?: license)?
bsd-3-clause | opensource org licenses bsd 3 clause
bsd-2-clause | opensource org licenses bsd 2 clause
isc | opensource org licenses isc
gpl-3.0 | gnu org licenses gpl 3 0
gpl-2.0 | gnu org licenses (?:old licenses )?gpl 2 0
gpl | gnu org (?:licenses|copyleft) gpl
lgpl-2.1 | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 | gnu org licenses lgpl 3 0
lgpl | gnu org (?:licenses|copyleft) lgpl
agpl-3.0 | gnu org licenses agpl 3 0
gfdl | gnu org (?:licenses|copyleft) fdl
mpl-2.0 | mozilla org mpl 2 0
mpl-1.1 | mozilla org mpl (?:mpl )?1 1
epl-1.0 | eclipse org legal epl v10
epl-2.0 | eclipse org legal epl (?:v20|2 0)
cc-by-4.0 | creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons org licenses by 3 0
cc-by-2.0 | creativecommons org licenses by 2 0
cc-by-sa-4.0 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | creativecommons org licenses by nc 4 0
cc-by-nc-3.0 | creativecommons org licenses by nc 3 0
cc-by-nc-sa-4.0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | creativecommons org licenses by nc sa 3 0
cc-by-nd-4.0 | creativecommons org licenses by nd 4 0
cc-by-nc-nd-4.0 | creativecommons org licenses by nc nd 4 0
cc0-1.0 | creativecommons org publicdomain zero 1 0
public-domain | creativecommons org publicdomain mark 1 0
unlicense | unlicense org
wtfpl | wtfpl net
bsl-1.0 | boost org license 1 0
ofl-1.1 | scripts sil org ofl
odbl-1.0 | opendatacommons org licenses odbl
""",
    # a license named with its version
    ("version", 0.9): r"""
apache-2.0 | apache (?:software )?licen[sc]e(?: version| v)? v?2(?: 0)?
apache-2.0 | apache 2 0 licen[sc]ed?
apache-1.1 | apache (?:software )?licen[sc]e(?: version| v)? v?1 1
gpl-3.0 | gnu general public licen[sc]e(?: version| v)? v?3(?: 0)?
gpl-2.0 | gnu general public licen[sc]e(?: version| v)? v?2(?: 0)?
gpl-1.0 | gnu general public licen[sc]e(?: version| v)? v?1(?: 0)?
gpl-3.0 | (?:gnu )?gpl (?:version |v )?v?3(?: 0)?
gpl-2.0 | (?:gnu )?gpl (?:version |v )?v?2(?: 0)?
gpl-3.0 | (?:gnu )?gplv3
gpl-2.0 | (?:gnu )?gplv2
lgpl-3.0 | (?:gnu )?lgplv3
lgpl-2.1 | (?:gnu )?lgplv2(?: 1)?
agpl-3.0 | (?:gnu )?agplv3
lgpl-3.0 | gnu lesser general public licen[sc]e(?: version| v)? v?3(?: 0)?
lgpl-2.1 | gnu lesser general public licen[sc]e(?: version| v)? v?2 1
lgpl-3.0 | (?:gnu )?lgpl (?:version |v )?v?3(?: 0)?
lgpl-2.1 | (?:gnu )?lgpl (?:version |v )?v?2 1
agpl-3.0 | gnu affero general public licen[sc]e(?: version| v)? v?3(?: 0)?
agpl-3.0 | (?:gnu )?agpl (?:version |v )?v?3(?: 0)?
mpl-2.0 | mozilla public licen[sc]e(?: version| v)? v?2(?: 0)?
mpl-1.1 | mozilla public licen[sc]e(?: version| v)? v?1 1
epl-2.0 | eclipse public licen[sc]e(?: version| v)? v?2(?: 0)?
epl-1.0 | eclipse public licen[sc]e(?: version| v)? v?1(?: 0)?
cc-by-4.0 | cc by(?: v)? v?4 0
cc-by-3.0 | cc by(?: v)? v?3 0
cc-by-2.5 | cc by(?: v)? v?2 5
cc-by-2.0 | cc by(?: v)? v?2 0
cc-by-sa-4.0 | cc by sa(?: v)? v?4 0
cc-by-sa-3.0 | cc by sa(?: v)? v?3 0
cc-by-nc-4.0 | cc by nc(?: v)? v?4 0
cc-by-nc-3.0 | cc by nc(?: v)? v?3 0
cc-by-nc-sa-4.0 | cc by nc sa(?: v)? v?4 0
cc-by-nc-nd-4.0 | cc by nc nd(?: v)? v?4 0
cc-by-nd-4.0 | cc by nd(?: v)? v?4 0
cc-by-4.0 | creative commons attribution(?: version| v)? v?4 0
cc-by-3.0 | creative commons attribution(?: version| v)? v?3 0
cc-by-sa-4.0 | creative commons attribution share ?alike(?: version| v)? v?4 0
cc-by-sa-3.0 | creative commons attribution share ?alike(?: version| v)? v?3 0
cc-by-nc-4.0 | creative commons attribution non ?commercial(?: version| v)? v?4 0
artistic-2.0 | artistic licen[sc]e(?: version| v)? v?2(?: 0)?
eupl-1.2 | eupl(?: version| v)? v?1 2
ofl-1.1 | (?:sil )?open font licen[sc]e(?: version| v)? v?1 1
bsd-3-clause | bsd (?:3|three) clause
bsd-3-clause | (?:3|three) clause bsd
bsd-2-clause | bsd (?:2|two) clause
bsd-2-clause | (?:2|two) clause bsd
bsd-4-clause | bsd (?:4|four) clause
bsd-4-clause | (?:4|four) clause bsd
bsd-3-clause | (?:new|modified|revised) bsd licen[sc]e
bsd-2-clause | freebsd licen[sc]e
bsd-2-clause | simplified bsd licen[sc]e
""",
    # a license named
    ("name", 0.8): r"""
gpl | gnu general public licen[sc]e
lgpl | gnu (?:lesser|library) general public licen[sc]e
agpl | gnu affero general public licen[sc]e
gfdl | gnu free documentation licen[sc]e
apache | apache (?:software |public )?licen[sc]e
mit | (?:the )?mit(?: x11| expat)? licen[sc]ed?
mit | expat licen[sc]e
mit | (?:released|licensed|distributed|available) under (?:the )?(?:terms of (?:the )?)?mit
gpl | (?:released|licensed|distributed|available) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl
lgpl | (?:released|licensed|distributed|available) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?lgpl
bsd | (?:released|licensed|distributed|available) under (?:the |a )?(?:terms of (?:the )?)?bsd
bsd | bsd(?: style| like)? licen[sc]e
cc-by | cc by
cc-by-sa | cc by sa
cc-by-nc | cc by nc
cc-by-nd | cc by nd
cc-by-nc-sa | cc by nc sa
cc-by-nc-nd | cc by nc nd
cc0-1.0 | cc0(?: 1 0)?
cc0-1.0 | creative commons zero
cc-by | creative commons attribution
cc-by-sa | creative commons attribution share ?alike
cc-by-nc | creative commons attribution non ?commercial
cc-by-nd | creative commons attribution no ?deriv(?:ative)?s
mpl | mozilla public licen[sc]e
epl | eclipse public licen[sc]e
cddl | common development and distribution licen[sc]e
isc | isc licen[sc]e
zlib | zlib(?: libpng)? licen[sc]e
bsl-1.0 | boost software licen[sc]e
unlicense | the unlicense
wtfpl | wtfpl
artistic | (?:perl )?artistic licen[sc]e
ofl | (?:sil )?open font licen[sc]e
psf | python software foundation licen[sc]e
php | php licen[sc]e
ruby | ruby licen[sc]e
postgresql | postgresql licen[sc]e
ncsa | university of illinois open source licen[sc]e
ms-pl | microsoft public licen[sc]e
eupl | european union public licen[sc]e
cecill | cecill licen[sc]e
sspl | server side public licen[sc]e
busl | business source licen[sc]e
beerware | beerware(?: licen[sc]e)?
odbl | open database licen[sc]e
public-domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
proprietary | all rights reserved
""",
    # words that hint at a license without naming one
    ("hint", 0.4): r"""
unknown | see (?:the )?licen[sc]e(?: file| txt| md)?(?: for (?:more )?(?:details|information))?
unknown | licensed under (?:the|a) (?:same )?terms
unknown | licen[sc]e agreement
unknown | copyleft licen[sc]e
unknown | permissive (?:open source )?licen[sc]e
unknown | open source licen[sc]e
unknown | creative commons(?: licen[sc]e)?
unknown | (?:gnu )?gpl
unknown | (?:gnu )?lgpl
""",
}


@dataclass(frozen=True)
class Rule:
    """A signature: where its pattern matches, its label is found with its confidence."""

    name: str
    label: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]
    pattern: str

    def compiled(self) -> re.Pattern[bytes]:
        return re.compile(rf"(?<![^ ])(?:{self.pattern})(?![^ ])".encode())


_COMMON = set("a and any are as at be by for in is it not of on or that the this to under v with you your".split())


def _gap(group: re.Match[str]) -> str:
    """What stands for a group: a break of the word before or after it, if its choices bring the space."""
    choices = group[1].split("|")
    return " " * all(c.startswith(" ") for c in choices) + "\x00" + " " * all(c.endswith(" ") for c in choices)


def keywords(pattern: str) -> tuple[str, ...]:
    """The plain words outside of groups, classes and options, without the common ones if others are left."""
    flat, before = pattern, ""
    while flat != before:  # groups, innermost first
        before, flat = flat, re.sub(r"\((?:\?:)?([^()]*)\)(?:\?|\{[0-9,]+\})?", _gap, flat)
    flat = re.sub(r"\S+ \?\S*", "\x00", flat)  # a space that may be missing
    plain = [w for w in flat.split(" ") if re.fullmatch("[a-z0-9]+", w)]
    plain = [w for w in plain if w not in _COMMON] or plain
    if not plain:
        raise ValueError(f"no word is in every match of {pattern}")
    return tuple(dict.fromkeys(plain))


def _written() -> list[Rule]:
    out = []
    for place, ((section, confidence), lines) in enumerate(reversed(_SECTIONS.items()), 1):
        for i, line in enumerate(lines.strip().splitlines()):
            label, pattern = (part.strip() for part in line.split("|", 1))
            out.append(Rule(f"{section}-{i}-{label}", label, place, confidence, keywords(pattern), pattern))
    return out


RULES = tuple(sorted(_written(), key=lambda r: -r.priority))
