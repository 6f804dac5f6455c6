"""Signature rules for licences.

Patterns are written over words: lower case, single blanks, no punctuation ("Apache License, Version 2.0" is
``apache license version 2 0``). Every rule names a keyword, a word without which its pattern cannot match.
"""

from __future__ import annotations

from typing import NamedTuple

#: fixed values: phrases that are counted at all their places, and their labels
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

#: label | keyword | pattern of the name, as people write it
NAMES = """
mit | mit | mit(?: x11)?(?: license| licence)
mit | expat | expat license
mit-0 | mit | mit no attribution(?: license)?
x11 | x11 | x11 license
apache-1.0 | apache | apache(?: software)? license (?:version |v )?1 0
apache-1.1 | apache | apache(?: software)? license (?:version |v )?1 1
apache-2.0 | apache | apache(?: software)?(?: license| licence)?(?: version| v)? 2 0(?: license)?
apache-2.0 | asl | asl 2 0
bsd-2-clause | bsd | (?:simplified bsd|bsd 2 clause|2 clause bsd)(?: license| licence)?
bsd-2-clause | freebsd | freebsd(?: license| licence)?
bsd-3-clause | bsd | (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: license| licence)?
bsd-4-clause | bsd | (?:original bsd|bsd 4 clause|4 clause bsd)(?: license| licence)?
0bsd | 0bsd | 0bsd(?: license)?
0bsd | bsd | (?:zero clause bsd|bsd zero clause)(?: license)?
bsd | bsd | bsd(?: style)? (?:license|licence)
gpl-1.0 | gpl | (?:gnu )?gpl(?: license)?(?: version| v)? 1(?: 0)?
gpl-1.0 | general | (?:gnu )?general public license(?: version| v) 1(?: 0)?
gpl-2.0 | gpl | (?:gnu )?gpl(?: license)?(?: version| v)? 2(?: 0)?(?: only)?
gpl-2.0 | gplv2 | (?:gnu )?gplv2
gpl-2.0 | general | (?:gnu )?general public license(?: version| v) 2(?: 0)?(?: only)?
gpl-2.0-or-later | gpl | (?:gnu )?gpl(?: version| v)? 2(?: 0)? or (?:any )?later(?: version)?
gpl-2.0-or-later | general | (?:gnu )?general public license(?: version| v) 2(?: 0)? or (?:at your option )?(?:any )?later version
gpl-3.0 | gpl | (?:gnu )?gpl(?: license)?(?: version| v)? 3(?: 0)?(?: only)?
gpl-3.0 | gplv3 | (?:gnu )?gplv3
gpl-3.0 | general | (?:gnu )?general public license(?: version| v) 3(?: 0)?(?: only)?
gpl-3.0-or-later | gpl | (?:gnu )?gpl(?: version| v)? 3(?: 0)? or (?:any )?later(?: version)?
gpl-3.0-or-later | general | (?:gnu )?general public license(?: version| v) 3(?: 0)? or (?:at your option )?(?:any )?later version
gpl | gnu | gnu general public (?:license|licence)
gpl | gpl | gnu gpl
lgpl-2.0 | library | (?:gnu )?library general public license(?: version| v)? 2(?: 0)?
lgpl-2.1 | lgpl | (?:gnu )?lgpl(?: version| v)? 2 1(?: only)?
lgpl-2.1 | lesser | (?:gnu )?lesser general public license(?: version| v)? 2 1
lgpl-3.0 | lgpl | (?:gnu )?lgpl(?: version| v)? 3(?: 0)?(?: only)?
lgpl-3.0 | lgplv3 | (?:gnu )?lgplv3
lgpl-3.0 | lesser | (?:gnu )?lesser general public license(?: version| v)? 3(?: 0)?
lgpl | lesser | (?:gnu )?lesser general public (?:license|licence)
agpl-3.0 | agpl | (?:gnu )?agpl(?: version| v)? 3(?: 0)?
agpl-3.0 | agplv3 | (?:gnu )?agplv3
agpl-3.0 | affero | (?:gnu )?affero general public license(?: version| v)? 3(?: 0)?
agpl | affero | (?:gnu )?affero general public (?:license|licence)
gfdl-1.2 | documentation | (?:gnu )?free documentation license(?: version| v)? 1 2
gfdl-1.3 | documentation | (?:gnu )?free documentation license(?: version| v)? 1 3
gfdl | documentation | (?:gnu )?free documentation license
mpl-1.1 | mozilla | mozilla public license(?: version| v)? 1 1
mpl-1.1 | mpl | mpl(?: version| v)? 1 1
mpl-2.0 | mozilla | mozilla public license(?: version| v)? 2 0
mpl-2.0 | mpl | mpl(?: version| v)? 2 0
mpl | mozilla | mozilla public license
epl-1.0 | eclipse | eclipse public license(?: version| v)? 1 0
epl-1.0 | epl | epl(?: version| v)? 1 0
epl-2.0 | eclipse | eclipse public license(?: version| v)? 2 0
epl-2.0 | epl | epl(?: version| v)? 2 0
epl | eclipse | eclipse public license
edl-1.0 | eclipse | eclipse distribution license(?: version| v)? 1 0
eupl-1.1 | eupl | eupl(?: version| v)? 1 1
eupl-1.2 | eupl | eupl(?: version| v)? 1 2
eupl | union | european union public licen[cs]e
cddl-1.0 | cddl | cddl(?: version| v)? 1 0
cddl-1.1 | cddl | cddl(?: version| v)? 1 1
cddl | common | common development and distribution license
cpl-1.0 | common | common public license(?: version| v)? 1 0
artistic-1.0 | artistic | artistic license(?: version| v)? 1 0
artistic-2.0 | artistic | artistic license(?: version| v)? 2 0
artistic | artistic | artistic license
isc | isc | isc (?:license|licence)
zlib | zlib | zlib(?: libpng)? license
libpng | libpng | libpng license
boost-1.0 | boost | boost software license(?: version| v)?(?: 1 0)?
boost-1.0 | bsl | bsl 1 0
unlicense | unlicense | (?:the )?unlicense
wtfpl | wtfpl | wtfpl
wtfpl | fuck | do what the fuck you want to public license
beerware | beerware | beerware(?: license)?
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | commons | creative commons zero(?: 1 0)?
cc-by-1.0 | cc | cc by 1 0
cc-by-2.0 | cc | cc by 2 0
cc-by-2.5 | cc | cc by 2 5
cc-by-3.0 | cc | cc by 3 0
cc-by-4.0 | cc | cc by 4 0
cc-by | commons | creative commons attribution(?: license)?
cc-by-3.0 | commons | creative commons attribution 3 0
cc-by-4.0 | commons | creative commons attribution 4 0
cc-by-sa-2.0 | cc | cc by sa 2 0
cc-by-sa-2.5 | cc | cc by sa 2 5
cc-by-sa-3.0 | cc | cc by sa 3 0
cc-by-sa-4.0 | cc | cc by sa 4 0
cc-by-sa-3.0 | commons | creative commons attribution share ?alike 3 0
cc-by-sa-4.0 | commons | creative commons attribution share ?alike 4 0
cc-by-sa | commons | creative commons attribution share ?alike
cc-by-nd-3.0 | cc | cc by nd 3 0
cc-by-nd-4.0 | cc | cc by nd 4 0
cc-by-nd | commons | creative commons attribution no ?deriv(?:ative|atives|s)?
cc-by-nc-2.0 | cc | cc by nc 2 0
cc-by-nc-3.0 | cc | cc by nc 3 0
cc-by-nc-4.0 | cc | cc by nc 4 0
cc-by-nc-4.0 | commons | creative commons attribution non ?commercial 4 0
cc-by-nc | commons | creative commons attribution non ?commercial
cc-by-nc-sa-3.0 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc | cc by nc sa 4 0
cc-by-nc-sa | commons | creative commons attribution non ?commercial share ?alike
cc-by-nc-nd-3.0 | cc | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc | cc by nc nd 4 0
cc-by-nc-nd | commons | creative commons attribution non ?commercial no ?deriv(?:ative|atives|s)?
cc-pdm-1.0 | mark | public domain mark(?: 1 0)?
odbl-1.0 | odbl | odbl(?: 1 0)?
odbl-1.0 | database | open (?:data commons open )?database license
odc-by-1.0 | odc | odc by(?: 1 0)?
pddl-1.0 | pddl | pddl(?: 1 0)?
ogl-uk-3.0 | government | open government licence(?: version| v)? 3 0
ogl-uk | government | open government licen[cs]e
etalab-2.0 | etalab | (?:licence ouverte )?etalab(?: version| v)? 2 0
ofl-1.1 | font | sil open font license(?: version| v)?(?: 1 1)?
ofl-1.1 | ofl | ofl 1 1
python-2.0 | python | python software foundation license(?: version| v)?(?: 2(?: 0)?)?
psf-2.0 | psf | psf license(?: version| v)?(?: 2(?: 0)?)?
php-3.01 | php | php license(?: version| v)?(?: 3 01)?
ruby | ruby | ruby license
vim | vim | vim license
openssl | openssl | openssl license
sleepycat | sleepycat | sleepycat license
postgresql | postgresql | postgresql license
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? license
ms-pl | microsoft | microsoft public license
ms-rl | microsoft | microsoft reciprocal license
ms-pl | ms | ms pl
intel | intel | intel open source license
w3c | w3c | w3c software(?: notice and)? license
afl-3.0 | academic | academic free license(?: version| v)?(?: 3 0)?
osl-3.0 | open | open software license(?: version| v)?(?: 3 0)?
apsl-2.0 | apple | apple public source license(?: version| v)?(?: 2 0)?
ecl-2.0 | educational | educational community license(?: version| v)?(?: 2 0)?
cecill-2.1 | cecill | cecill(?: free software license agreement)?(?: version| v)?(?: 2 1)?
upl-1.0 | universal | universal permissive license(?: version| v)?(?: 1 0)?
bsl-1.1 | business | business source license(?: version| v)?(?: 1 1)?
sspl-1.0 | sspl | sspl(?: version| v)?(?: 1(?: 0)?)?
sspl-1.0 | server | server side public license(?: version| v)?(?: 1(?: 0)?)?
elastic-2.0 | elastic | elastic license(?: version| v)?(?: 2 0)?
openrail | openrail | (?:bigscience |creativeml )?openrail(?: m)?(?: license)?
llama | llama | llama (?:2 |3 )?community license(?: agreement)?
"""

#: label | keyword | pattern of a sentence from the licence's own text
TEXTS = """
mit | permission | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | merchantability | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
isc | permission | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse | neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
apache-2.0 | apache | www apache org licenses license 2 0
apache-2.0 | governing | see the license for the specific language governing permissions and limitations under the license
gpl | free | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
lgpl | free | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
gpl | gnu | www gnu org licenses(?: gpl(?: 3 0)?(?: html)?)?
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
zlib | altered | altered source versions must be plainly marked as such
unlicense | unencumbered | this is free and unencumbered software released into the public domain
boost-1.0 | boost | www boost org license 1 0 txt
cc-by-4.0 | creativecommons | creativecommons org licenses by 4 0
cc-by-sa-4.0 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-nc-4.0 | creativecommons | creativecommons org licenses by nc 4 0
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
ofl-1.1 | scripts | scripts sil org ofl
"""

#: label | keyword | pattern of a hint that names no licence
HINTS = """
public-domain | domain | (?:in|into|to) the public domain
proprietary | rights | all rights reserved
proprietary | confidential | proprietary and confidential
proprietary | permission | (?:may not be|not to be) (?:copied|reproduced|redistributed)(?: or \\w+)? without(?: prior| written| express| prior written)? permission
"""


class Rule(NamedTuple):
    number: int
    label: str
    keyword: str
    pattern: str
    priority: int  # 5 tag, 4 notice, 3 licence text, 2 name, 1 base phrase or hint
    base: bool


#: how sure a detection of each priority is
CONFIDENCE = {5: 1.0, 4: 0.95, 3: 0.9, 2: 0.7, 1: 0.4}

_NOTICE = (
    "(?:licensed|released|distributed|published|available|provided|licence|license) (?:to you )?"
    "(?:under|by|with|is) (?:the )?(?:terms of )?(?:the )?"
)
_TAG = "spdx license identifier "


def _rows(block: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" | ")] for line in block.strip().splitlines()]


def rules() -> list[Rule]:
    """Every name as a tag, as a notice and bare; then licence texts, hints and base phrases. In order of precedence."""
    made = [(label, word, _TAG + name, 5, False) for label, word, name in _rows(NAMES)]
    made += [(label, "spdx", _TAG + " ".join(label.replace("-", " ").replace(".", " ").split()), 5, False) for label in sorted({row[0] for row in _rows(NAMES)})]
    made += [(label, word, _NOTICE + name, 4, False) for label, word, name in _rows(NAMES)]
    made += [(*row, 3, False) for row in _rows(TEXTS)]
    made += [(*row, 2, False) for row in _rows(NAMES)]
    made += [(label, phrase.split()[0], phrase, 1, True) for phrase, label in BASE_PHRASES]
    made += [(*row, 1, False) for row in _rows(HINTS)]
    return [Rule(number, *fields) for number, fields in enumerate(made)]
