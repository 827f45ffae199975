"""Signature rules for licence texts.

A rule matches on a text's words: lower case, joined by single spaces. ``NAMES`` lists, for
each licence, its label, a keyword without which no rule of it can match, and hand-written
patterns of its names (``(v)`` stands for an optional version word). The keyword begins at
a word's start. From each name come
the forms in which licences are given: the bare name and a grant ("licensed under the ...").
``IDS`` are short identifiers; many are ordinary words, so they count in a tag, a grant or with
the word licence alone. ``TEXTS`` are passages of licence texts themselves.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    #: 0 a tag or a grant, 1 a name or a passage of the text, 2 a hint
    priority: int
    keyword: str
    pattern: str


_V = r"(?:version |ver |v )?"
#: label | keyword | patterns over words
NAMES = r"""
mit | mit licen | mit licen[sc]e | x11 mit license
mit | mit x11 | mit x11 license
mit | expat | expat license
mit-0 | mit 0 | mit 0
mit-0 | mit no | mit no attribution( license)?
apache-2 | apache | apache license (v)2( 0)? | apache 2( 0)? license | apache software license (v)2( 0)? | asl 2( 0)? apache | apache licence (v)2( 0)?
apache-1.1 | apache | apache (software )?license (v)1 1
apache-1.0 | apache | apache (software )?license (v)1 0
bsd-2-clause | bsd | bsd 2 clause( license)? | 2 clause bsd( license)? | simplified bsd license | two clause bsd license
bsd-2-clause | freebsd | freebsd license
bsd-3-clause | bsd | bsd 3 clause( license)? | 3 clause bsd( license)? | new bsd license | modified bsd license | revised bsd license | three clause bsd license
bsd-4-clause | bsd | bsd 4 clause( license)? | 4 clause bsd( license)? | original bsd license | old bsd license
bsd-0-clause | bsd | bsd zero clause( license)? | zero clause bsd
bsd-0-clause | 0bsd | 0bsd( license)?
bsd | bsd | bsd style license | bsd licen[sc]e | berkeley software distribution license bsd
gpl-1 | gnu | gnu general public license (v)1( 0)? | gnu gpl (v)1( 0)?
gpl-2 | gnu | gnu general public licen[sc]e (v)2( 0)? | gnu gpl (v)2( 0)? | gnu gplv2 | version 2 of the gnu general public license
gpl-3 | gnu | gnu general public licen[sc]e (v)3( 0)? | gnu gpl (v)3( 0)? | gnu gplv3 | version 3 of the gnu general public license
gpl-2-only | gpl | gpl 2 0 only | gpl 2 only | gplv2 only
gpl-2-or-later | gpl | gpl 2 0 or later | gpl 2 or later | gplv2 or later
gpl-3-only | gpl | gpl 3 0 only | gpl 3 only | gplv3 only
gpl-3-or-later | gpl | gpl 3 0 or later | gpl 3 or later | gplv3 or later
gpl-2 | gpl | gpl (v)2( 0)? | gplv2
gpl-3 | gpl | gpl (v)3( 0)? | gplv3
gpl | gnu | gnu general public licen[sc]e | gnu gpl
lgpl-2 | gnu | gnu library general public licen[sc]e (v)2( 0)? | gnu lgpl (v)2( 0)?
lgpl-2.1 | gnu | gnu lesser general public licen[sc]e (v)2 1 | gnu lgpl (v)2 1
lgpl-3 | gnu | gnu lesser general public licen[sc]e (v)3( 0)? | gnu lgpl (v)3( 0)?
lgpl-2.1 | lgpl | lgpl (v)2 1 | lgplv2 1
lgpl-3 | lgpl | lgpl (v)3( 0)? | lgplv3
lgpl | gnu | gnu (lesser|library) general public licen[sc]e | gnu lgpl
agpl-1 | affero | affero general public license (v)1( 0)?
agpl-3 | affero | gnu affero general public licen[sc]e (v)3( 0)? | affero gpl (v)3( 0)?
agpl-3 | agpl | agpl (v)3( 0)? | agplv3
agpl | affero | (gnu )?affero general public licen[sc]e
gfdl-1.1 | gnu | gnu free documentation license (v)1 1
gfdl-1.2 | gnu | gnu free documentation license (v)1 2
gfdl-1.3 | gnu | gnu free documentation license (v)1 3
gfdl | gnu | gnu free documentation licen[sc]e
mpl-1.0 | mozilla | mozilla public license (v)1 0
mpl-1.1 | mozilla | mozilla public license (v)1 1 | mpl 1 1 mozilla
mpl-2.0 | mozilla | mozilla public licen[sc]e (v)2( 0)? | mpl 2 0 mozilla
mpl-2.0 | mpl | mpl (v)2( 0)?
epl-1.0 | eclipse | eclipse public license (v)1( 0)?
epl-2.0 | eclipse | eclipse public license (v)2( 0)?
edl-1.0 | eclipse | eclipse distribution license (v)1( 0)?
cddl-1.0 | common development | common development and distribution license (v)1( 0)?
cddl-1.1 | common development | common development and distribution license (v)1 1
cddl | common development | common development and distribution license
cpl-1.0 | common public | common public license (v)1( 0)?
cpal-1.0 | common public | common public attribution license (v)1( 0)?
ipl-1.0 | ibm | ibm public license (v)1( 0)?
eupl-1.1 | union | european union public licen[sc]e (v)1 1
eupl-1.2 | union | european union public licen[sc]e (v)1 2
osl-3.0 | open software | open software license (v)3( 0)?
osl-2.1 | open software | open software license (v)2 1
afl-3.0 | academic | academic free license (v)3( 0)?
afl-2.1 | academic | academic free license (v)2 1
ecl-2.0 | educational | educational community license (v)2( 0)?
artistic-1.0 | artistic | artistic license (v)1( 0)?
artistic-2.0 | artistic | artistic license (v)2( 0)?
artistic | artistic | artistic licen[sc]e | same terms as perl itself artistic
isc | isc | isc licen[sc]e | internet systems consortium license isc
zlib | zlib | zlib licen[sc]e | zlib libpng license | license of zlib
libpng | libpng | libpng license( (v)2)?
bsl-1.0 | boost | boost software licen[sc]e (v)1( 0)? | boost software licen[sc]e
python-2.0 | python | python license (v)2( 0)? | psf license (v)2 python | python software foundation license( (v)2)?
php-3.01 | php | php license (v)3 0?1
ruby | ruby | ruby license | same terms as ruby
postgresql | postgresql | postgresql licen[sc]e
openssl | openssl | openssl license | openssl ssleay license
openldap | openldap | openldap public license (v)2 8
curl | curl | curl license
ncsa | ncsa | university of illinois ncsa open source license | ncsa open source license
w3c | w3c | w3c software (notice and )?license | w3c license
unicode | unicode | unicode (data files and software )?license( agreement)?
unlicense | unlicense | the unlicense | unlicense license
wtfpl | what the f | do what the f\w+ you want to public license
wtfpl | wtfpl | wtfpl( (v)2)?
cc0-1.0 | cc0 | cc0( 1 0)?( universal)?
cc0-1.0 | creative commons | creative commons zero( (v)1( 0)?)?( universal)?
cc-by | cc by | cc by( [1-4] [05])?
cc-by-sa | cc by | cc by sa( [1-4] [05])?
cc-by-nd | cc by | cc by nd( [1-4] [05])?
cc-by-nc | cc by | cc by nc( [1-4] [05])?
cc-by-nc-sa | cc by | cc by nc sa( [1-4] [05])?
cc-by-nc-nd | cc by | cc by nc nd( [1-4] [05])?
cc-by | creative commons | creative commons attribution( [1-4] [05])?( (international|unported|generic))?( licen[sc]e)?
cc-by-sa | creative commons | creative commons attribution share ?alike( [1-4] [05])?( (international|unported|generic))?( licen[sc]e)?
cc-by-nd | creative commons | creative commons attribution no ?deriv(ative)?s?( works)?( [1-4] [05])?( licen[sc]e)?
cc-by-nc | creative commons | creative commons attribution non ?commercial( [1-4] [05])?( (international|unported|generic))?( licen[sc]e)?
cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike( [1-4] [05])?( (international|unported|generic))?( licen[sc]e)?
cc-by-nc-nd | creative commons | creative commons attribution non ?commercial no ?deriv(ative)?s?( works)?( [1-4] [05])?( licen[sc]e)?
cc-pd | creative commons | creative commons public domain( mark)?( 1 0)?
odbl-1.0 | open d | open (data commons open )?database license( (v)1( 0)?)? | odbl open database license
odc-by-1.0 | open data | open data commons attribution license( (v)1( 0)?)?
pddl-1.0 | open data | open data commons public domain dedication( and license)?
ogl-uk | open government | open government licen[sc]e( (v)[123]( 0)?)?
ofl-1.1 | ofl | sil ofl( 1 1)? | ofl 1 1
ofl-1.1 | open font | (sil )?open font license( (v)1 1)?
ms-pl | microsoft | microsoft public license( ms pl)?
ms-rl | microsoft | microsoft reciprocal license( ms rl)?
apsl-2.0 | apple | apple public source license( (v)2( 0)?)?
qpl-1.0 | q public | q public license( (v)1( 0)?)?
sleepycat | sleepycat | sleepycat license
zpl-2.1 | zope | zope public license( (v)2 [01])?
lppl-1.3c | latex | latex project public license( (v)1 3c?)?
vim | vim | vim license
sspl-1.0 | server side | server side public license( (v)1( 0)?)?
busl-1.1 | business source | business source license( (v)1 1)?
elastic-2.0 | elastic | elastic license( (v)2( 0)?)?
polyform | polyform | polyform (noncommercial|shield|strict|small business) license( 1 0 0)?
hippocratic | hippocratic | hippocratic license( (v)[123]( [0-9])?)?
openrail | openrail | (creativeml |bigscience )?openrail( (m|s|d))?( license)?
openrail | open rail | (creativeml |bigscience )?open rail( (m|s|d))?( license)?
llama | llama | llama [23]? ?community license( agreement)?
cecill-2.1 | cecill | cecill( free software license agreement)?( (v)2( [01])?)?
mulan-2 | mulan | mulan (psl|permissive software license)( (v)2)?
upl-1.0 | universal permissive | universal permissive license( (v)1( 0)?)?
blueoak | blue oak | blue oak model license( 1 0 0)?
json | json | json license
beerware | beer | beer ?ware license
hpnd | historical | historical permission notice and disclaimer
jpl-image | jpl | jpl image use policy
nasa-1.3 | nasa | nasa open source agreement( (v)1 3)?
rpl-1.5 | reciprocal | reciprocal public license( (v)1 5)?
sissl | sun | sun industry standards source license
watcom | watcom | sybase open watcom public license
wxwindows | wxwindows | wxwindows library licen[sc]e
xnet | x net | x net license
"""

#: SPDX identifiers: label | identifiers. Fixed values.
IDS = """
mit | MIT | X11 | MIT-Modern-Variant
mit-0 | MIT-0
apache-2 | Apache-2.0
apache-1.1 | Apache-1.1
apache-1.0 | Apache-1.0
bsd-0-clause | 0BSD
bsd-2-clause | BSD-2-Clause
bsd-3-clause | BSD-3-Clause
bsd-4-clause | BSD-4-Clause
gpl-1 | GPL-1.0 | GPL-1.0-only | GPL-1.0-or-later
gpl-2 | GPL-2.0
gpl-2-only | GPL-2.0-only
gpl-2-or-later | GPL-2.0-or-later
gpl-3 | GPL-3.0
gpl-3-only | GPL-3.0-only
gpl-3-or-later | GPL-3.0-or-later
lgpl-2 | LGPL-2.0-only | LGPL-2.0-or-later
lgpl-2.1 | LGPL-2.1 | LGPL-2.1-only | LGPL-2.1-or-later
lgpl-3 | LGPL-3.0 | LGPL-3.0-only | LGPL-3.0-or-later
agpl-3 | AGPL-3.0 | AGPL-3.0-only | AGPL-3.0-or-later
gfdl-1.1 | GFDL-1.1-only | GFDL-1.1-or-later
gfdl-1.2 | GFDL-1.2-only | GFDL-1.2-or-later
gfdl-1.3 | GFDL-1.3-only | GFDL-1.3-or-later
mpl-1.0 | MPL-1.0
mpl-1.1 | MPL-1.1
mpl-2.0 | MPL-2.0
epl-1.0 | EPL-1.0
epl-2.0 | EPL-2.0
cddl-1.0 | CDDL-1.0
cddl-1.1 | CDDL-1.1
cpl-1.0 | CPL-1.0
cpal-1.0 | CPAL-1.0
ipl-1.0 | IPL-1.0
eupl-1.1 | EUPL-1.1
eupl-1.2 | EUPL-1.2
osl-2.1 | OSL-2.1
osl-3.0 | OSL-3.0
afl-2.1 | AFL-2.1
afl-3.0 | AFL-3.0
ecl-2.0 | ECL-2.0
artistic-1.0 | Artistic-1.0
artistic-2.0 | Artistic-2.0
isc | ISC
zlib | Zlib
libpng | Libpng
bsl-1.0 | BSL-1.0
python-2.0 | Python-2.0 | PSF-2.0
php-3.01 | PHP-3.01
ruby | Ruby
postgresql | PostgreSQL
openssl | OpenSSL
openldap | OLDAP-2.8
curl | curl
ncsa | NCSA
w3c | W3C
unicode | Unicode-DFS-2016 | Unicode-3.0
unlicense | Unlicense
wtfpl | WTFPL
ms-pl | MS-PL
ms-rl | MS-RL
cc0-1.0 | CC0-1.0
cc-by | CC-BY-3.0 | CC-BY-4.0
cc-by-sa | CC-BY-SA-3.0 | CC-BY-SA-4.0
cc-by-nd | CC-BY-ND-4.0
cc-by-nc | CC-BY-NC-4.0
cc-by-nc-sa | CC-BY-NC-SA-4.0
cc-by-nc-nd | CC-BY-NC-ND-4.0
"""

#: Passages of licence texts and hints: label | priority | keyword | pattern
TEXTS = r"""
mit | 1 | granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 1 | the above copyright | the above copyright notice and this permission notice shall be included in all copies
isc | 1 | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd | 1 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 1 | endorse | neither the name of (\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 1 | acknowledg | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2 | 1 | compliance with the license | you may not use this file except in compliance with the license
apache-2 | 0 | apache org licenses | apache org licenses license 2 0
gpl | 1 | free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2-or-later | 0 | at your option | either version 2 of the license or at your option any later version
gpl-3-or-later | 0 | at your option | either version 3 of the license or at your option any later version
lgpl | 1 | lesser general | under the terms of the gnu lesser general public license
gpl | 1 | gnu org licenses | gnu org licenses( gpl)?
mpl-2.0 | 0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
bsl-1.0 | 1 | permission is | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
zlib | 1 | provided as is | this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense | 1 | unencumbered | this is free and unencumbered software released into the public domain
public-domain | 1 | public domain | (released into|placed in|dedicated to|is in|in) the public domain
public-domain | 2 | public domain | public domain
cc0-1.0 | 0 | publicdomain | creativecommons org publicdomain zero 1 0
cc-by | 0 | creativecommons | creativecommons org licenses by [1-4] [05]
cc-by-sa | 0 | creativecommons | creativecommons org licenses by sa [1-4] [05]
cc-by-nd | 0 | creativecommons | creativecommons org licenses by nd [1-4] [05]
cc-by-nc | 0 | creativecommons | creativecommons org licenses by nc [1-4] [05]
cc-by-nc-sa | 0 | creativecommons | creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd | 0 | creativecommons | creativecommons org licenses by nc nd [1-4] [05]
commercial | 1 | commercial license | (requires|under) a commercial license
proprietary | 1 | proprietary | proprietary and confidential
proprietary | 1 | unauthorized copying | unauthorized copying of this file (\S+ ){0,4}is strictly prohibited
proprietary | 2 | all rights reserved | all rights reserved
non-commercial | 2 | non commercial | (for )?non commercial (use|purposes) only
non-commercial | 2 | noncommercial | (for )?noncommercial (use|purposes) only
copyright | 2 | copyright | copyright( c)? (19|20)[0-9]{2}( (19|20)?[0-9]{2})?
"""


_GRANT = r"(?:licen[sc]ed|distributed|released|available|published|provided) (?:to you )?under"


def _id_rules(label: str, name: str) -> list[Rule]:
    """The forms of an identifier: a tag, also in an expression of several, grants, and with the word licence."""
    words = re.sub(r"[^a-z0-9]+", " ", name.lower())
    behind = rf"{words}(?: licen[sc]e)?"
    return [
        Rule(label, 0, "spdx license identifier", rf"spdx license identifier (?:(?:\S+ ){{1,8}}?(?:or|and) ){{0,4}}?{words}"),
        Rule(label, 0, f"under {words}", rf"{_GRANT} {behind}"),
        Rule(label, 0, f"under the {words}", rf"{_GRANT} the {behind}"),
        Rule(label, 0, f"terms of the {words}", rf"{_GRANT} the terms of the {behind}"),
        Rule(label, 1, f"license {words}", rf"license {words}"),
        Rule(label, 1, f"{words} licensed", rf"{words} licensed"),
    ]


def build_rules() -> list[Rule]:
    rules = []
    for line in IDS.strip().splitlines():
        label, *names = (x.strip() for x in line.split(" | "))
        for name in names:
            rules += _id_rules(label, name)
    for line in NAMES.strip().splitlines():
        label, keyword, *names = (x.strip() for x in line.split(" | "))
        for name in names:
            name = name.replace("(v)", _V)
            rules.append(Rule(label, 0, keyword,
                              rf"{_GRANT} (?:the |a |an )?(?:terms of )?(?:the |a |an )?(?:{name})(?: licen[sc]e)?"))
            rules.append(Rule(label, 1, keyword, rf"(?:{name})"))
    for line in TEXTS.strip().splitlines():
        label, priority, keyword, pattern = (x.strip() for x in line.split(" | ", 3))
        rules.append(Rule(label, int(priority), keyword, pattern))
    return [r._replace(pattern=rf"(?<= )(?:{r.pattern})(?= )") for r in rules]
