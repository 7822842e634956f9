"""Hand-written license signatures: what is looked for, how strong it is, and which keyword lets it be tried.

Each line holds a label, a kind, a keyword and a regular expression over lower-case words with one blank
between them. Kinds, strongest first: text (a sentence of a license), notice (somebody puts something under
a license), tag (an identifier or address), name (a license is only named). Where a line stands matters only
between detections of one kind in one place: the earlier line wins.

A word in {braces} stands for the pattern of that name in PARTS.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """keyword, needle and regex are over words with a blank on either side of each, so two between neighbours. The keyword or, where it is longer, a fixed part of the regex is the needle."""

    rule: int
    label: str
    priority: int
    keyword: str
    needle: str
    regex: str


KINDS = ("base", "text", "notice", "tag", "name")
PARTS = {
    "under": "(?:licen[cs]ed|released|distributed|published|available|provided|offered|shared|covered|governed|redistributed|issued) (?:to you )?(?:under|by|with) (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?",
    "by": "(?:under|per|by) (?:the )?(?:terms of )?(?:the |an? )?",
    "lic": "(?:public )?licen[cs]e",
    "url": "(?:https? )?(?:www )?",
    "spdx": "spdx licen[cs]e identifier ",
}

TABLE = r"""
mit | text | hereby  granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | text | hereby  granted | permission is hereby granted free of charge to any person
mit | text | warrant | the software is provided as is without warranty of any kind express or implied
mit | text | copyright | the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
mit | notice | licen | {under}mit licen[cs]e
mit | notice | licen | {under}(?:expat|x11) licen[cs]e
mit | notice | licen | (?:licen[cs]e|licen[cs]ed) (?:is )?(?:under )?mit
mit | tag | licen | {spdx}mit
mit | tag | licen | {url}opensource org licen[cs]es? mit(?: license)?(?: php)?
mit | tag | licen | {url}mit license org
mit | name | licen | (?:the )?mit (?:style |type )?licen[cs]e
mit | name | licen | (?:expat|x11) licen[cs]e
mit-0 | tag | licen | {spdx}mit 0
mit-0 | name | licen | mit (?:0|no attribution) licen[cs]e
isc | text | hereby  granted | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | notice | licen | {under}isc licen[cs]e
isc | tag | licen | {spdx}isc
isc | tag | licen | {url}opensource org licen[cs]es? isc
isc | name | licen | (?:the )?isc licen[cs]e
0bsd | tag | licen | {spdx}0bsd
0bsd | name | licen | (?:zero clause bsd|0bsd|bsd zero clause) licen[cs]e
bsd | text | redistribut | redistribution and use in source and binary forms with or without modification are permitted
bsd | text | redistribut | redistributions of source code must retain the above copyright notice
bsd | text | redistribut | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | text | permission | neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software
bsd-4-clause | text | copyright | all advertising materials mentioning features or use of this software must display
bsd | notice | licen | {under}(?:modified |simplified |new |revised )?bsd (?:style )?licen[cs]e
bsd-2-clause | notice | licen | {under}(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) licen[cs]e
bsd-3-clause | notice | licen | {under}(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e
bsd-2-clause | tag | licen | {spdx}bsd 2 clause
bsd-3-clause | tag | licen | {spdx}bsd 3 clause
bsd-4-clause | tag | licen | {spdx}bsd 4 clause
bsd-2-clause | tag | licen | {url}opensource org licen[cs]es? bsd 2 clause
bsd-3-clause | tag | licen | {url}opensource org licen[cs]es? bsd 3 clause
bsd-2-clause | name | licen | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd) licen[cs]e
bsd-3-clause | name | licen | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e
bsd-4-clause | name | licen | (?:bsd 4 clause|4 clause bsd|original bsd|old bsd) licen[cs]e
bsd | name | licen | bsd (?:style |type )?licen[cs]e
apache-2 | text | licen | licen[cs]ed under the apache licen[cs]e version 2 0 the license you may not use this file except in compliance with the license
apache-2 | text | licen | you may not use this file except in compliance with the license
apache-2 | text | licen | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2 | text | licen | subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
apache-2 | notice | licen | {under}apache (?:software )?licen[cs]e (?:version |v )?2(?: 0)?
apache-2 | notice | licen | {under}apache (?:2|2 0|v2)(?: 0)? licen[cs]e
apache | notice | licen | {under}apache (?:software )?licen[cs]e
apache-1.1 | notice | licen | {under}apache (?:software )?licen[cs]e (?:version |v )?1 1
apache-2 | tag | licen | {spdx}apache 2 0
apache-1.1 | tag | licen | {spdx}apache 1 1
apache-2 | tag | licen | {url}apache org licen[cs]es? license 2 0(?: txt| html)?
apache-2 | tag | licen | {url}opensource org licen[cs]es? apache 2 0
apache-2 | name | licen | apache (?:software )?licen[cs]e (?:version |v )?2(?: 0)?
apache-2 | name | licen | apache (?:2|2 0|v2)(?: 0)? licen[cs]e
apache-1.1 | name | licen | apache (?:software )?licen[cs]e (?:version |v )?1 1
apache | name | licen | apache (?:software )?licen[cs]e
gpl | text | licen | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | text | licen | it under the terms of the gnu general public license as published by the free software foundation
gpl-3 | text | licen | either version 3 of the license or (?:at your option )?any later version
gpl-2 | text | licen | either version 2 of the license or (?:at your option )?any later version
gpl | text | licen | you should have received a copy of the gnu general public license along with this program
gpl | text | copyleft | the gnu general public license is a free copyleft license for software and other kinds of works
gpl-3 | notice | licen | {under}gnu (?:general public licen[cs]e|gpl) (?:version |v )?3(?: 0)?
gpl-2 | notice | licen | {under}gnu (?:general public licen[cs]e|gpl) (?:version |v )?2(?: 0)?
gpl-1 | notice | licen | {under}gnu (?:general public licen[cs]e|gpl) (?:version |v )?1(?: 0)?
gpl | notice | licen | {under}gnu general public licen[cs]e
gpl | notice | gpl | {under}(?:gnu )?gpl
gpl-3 | notice | gpl | {under}(?:gnu )?(?:gplv3|gpl v3|gpl v 3|gpl version 3|gpl 3)(?: 0)?
gpl-2 | notice | gpl | {under}(?:gnu )?(?:gplv2|gpl v2|gpl v 2|gpl version 2|gpl 2)(?: 0)?
gpl-3 | tag | licen | {spdx}gpl 3 0(?: only| or later)?
gpl-2 | tag | licen | {spdx}gpl 2 0(?: only| or later)?
gpl-1 | tag | licen | {spdx}gpl 1 0(?: only| or later)?
gpl-3 | tag | gpl | {url}gnu org licen[cs]es? gpl 3 0(?: html| txt)?
gpl-2 | tag | gpl | {url}gnu org licen[cs]es? (?:old licen[cs]es )?gpl 2 0(?: html| txt)?
gpl | tag | gpl | {url}gnu org (?:copyleft|licen[cs]es?) gpl(?: html| txt)?
gpl-3 | name | licen | (?:gnu )?general public licen[cs]e (?:version |v )?3(?: 0)?
gpl-2 | name | licen | (?:gnu )?general public licen[cs]e (?:version |v )?2(?: 0)?
gpl | name | licen | gnu general public licen[cs]e
gpl-3 | name | gpl | (?:gnu )?(?:gplv3|gpl v3|gpl v 3|gpl version 3|gpl 3 0)
gpl-2 | name | gpl | (?:gnu )?(?:gplv2|gpl v2|gpl v 2|gpl version 2|gpl 2 0)
gpl | name | gpl | (?:gnu gpl|gpl licen[cs]ed?|the gpl)
lgpl | text | licen | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl | text | licen | you should have received a copy of the gnu (?:lesser|library) general public license
lgpl-3 | notice | licen | {under}gnu (?:lesser|library) general public licen[cs]e (?:version |v )?3(?: 0)?
lgpl-2.1 | notice | licen | {under}gnu (?:lesser|library) general public licen[cs]e (?:version |v )?2 1
lgpl-2 | notice | licen | {under}gnu (?:lesser|library) general public licen[cs]e (?:version |v )?2(?: 0)?
lgpl | notice | licen | {under}gnu (?:lesser|library) general public licen[cs]e
lgpl | notice | gpl | {under}(?:gnu )?lgpl
lgpl-3 | notice | gpl | {under}(?:gnu )?(?:lgplv3|lgpl v3|lgpl version 3|lgpl 3)(?: 0)?
lgpl-2.1 | notice | gpl | {under}(?:gnu )?(?:lgplv2 1|lgpl v2 1|lgpl version 2 1|lgpl 2 1)
lgpl-3 | tag | licen | {spdx}lgpl 3 0(?: only| or later)?
lgpl-2.1 | tag | licen | {spdx}lgpl 2 1(?: only| or later)?
lgpl-2 | tag | licen | {spdx}lgpl 2 0(?: only| or later)?
lgpl | tag | gpl | {url}gnu org (?:copyleft|licen[cs]es?) lgpl(?: 3 0| 2 1)?(?: html| txt)?
lgpl-3 | name | licen | (?:gnu )?lesser general public licen[cs]e (?:version |v )?3(?: 0)?
lgpl-2.1 | name | licen | (?:gnu )?lesser general public licen[cs]e (?:version |v )?2 1
lgpl | name | licen | (?:gnu )?(?:lesser|library) general public licen[cs]e
lgpl-3 | name | gpl | (?:lgplv3|lgpl v3|lgpl version 3|lgpl 3 0)
lgpl-2.1 | name | gpl | (?:lgplv2 1|lgpl v2 1|lgpl version 2 1|lgpl 2 1)
lgpl | name | gpl | (?:gnu lgpl|lgpl licen[cs]ed?|the lgpl)
agpl-3 | text | licen | it under the terms of the gnu affero general public license as published by the free software foundation
agpl-3 | text | licen | you should have received a copy of the gnu affero general public license
agpl-3 | notice | licen | {under}gnu affero general public licen[cs]e(?: (?:version |v )?3(?: 0)?)?
agpl-3 | notice | gpl | {under}(?:gnu )?(?:agplv3|agpl v3|agpl version 3|agpl 3)(?: 0)?
agpl | notice | gpl | {under}(?:gnu )?agpl
agpl-3 | tag | licen | {spdx}agpl 3 0(?: only| or later)?
agpl-1 | tag | licen | {spdx}agpl 1 0(?: only| or later)?
agpl | tag | gpl | {url}gnu org licen[cs]es? agpl(?: 3 0)?(?: html| txt)?
agpl-3 | name | licen | (?:gnu )?affero general public licen[cs]e (?:version |v )?3(?: 0)?
agpl | name | licen | (?:gnu )?affero general public licen[cs]e
agpl-3 | name | gpl | (?:agplv3|agpl v3|agpl version 3|agpl 3 0)
agpl | name | gpl | (?:gnu agpl|agpl licen[cs]ed?|the agpl)
gfdl | text | licen | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | notice | licen | {under}gnu free documentation licen[cs]e(?: (?:version |v )?1 [123])?
gfdl | tag | licen | {spdx}gfdl 1 [123](?: only| or later)?
gfdl | tag | licen | {url}gnu org (?:copyleft|licen[cs]es?) fdl(?: 1 3)?(?: html| txt)?
gfdl | name | licen | gnu free documentation licen[cs]e
cc-by | notice | cc  by | {under}cc by(?: [1234] [05])?
cc-by-sa | notice | cc  by | {under}cc by sa(?: [1234] [05])?
cc-by-nd | notice | cc  by | {under}cc by nd(?: [1234] [05])?
cc-by-nc | notice | cc  by | {under}cc by nc(?: [1234] [05])?
cc-by-nc-sa | notice | cc  by | {under}cc by nc sa(?: [1234] [05])?
cc-by-nc-nd | notice | cc  by | {under}cc by nc nd(?: [1234] [05])?
cc-by-nc-nd | notice | commons | {under}creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?
cc-by-nc-nd | notice | commons | {under}creative commons attribution noncommercial noderiv(?:ative)?s
cc-by-nc-sa | notice | commons | {under}creative commons attribution (?:non commercial|noncommercial) (?:share alike|sharealike)
cc-by-nc | notice | commons | {under}creative commons attribution (?:non commercial|noncommercial)
cc-by-nd | notice | commons | {under}creative commons attribution (?:no derivatives|noderivatives|noderivs|no derivs)
cc-by-sa | notice | commons | {under}creative commons attribution (?:share alike|sharealike)
cc-by | notice | commons | {under}creative commons attribution
cc | notice | commons | {under}creative commons
cc-by | tag | licen | {spdx}cc by [1234] [05]
cc-by-sa | tag | licen | {spdx}cc by sa [1234] [05]
cc-by-nd | tag | licen | {spdx}cc by nd [1234] [05]
cc-by-nc | tag | licen | {spdx}cc by nc [1234] [05]
cc-by-nc-sa | tag | licen | {spdx}cc by nc sa [1234] [05]
cc-by-nc-nd | tag | licen | {spdx}cc by nc nd [1234] [05]
cc0 | tag | licen | {spdx}cc0 1 0
cc-by | tag | licen | {url}creativecommons org licen[cs]es by [1234] [05]
cc-by-sa | tag | licen | {url}creativecommons org licen[cs]es by sa [1234] [05]
cc-by-nd | tag | licen | {url}creativecommons org licen[cs]es by nd [1234] [05]
cc-by-nc | tag | licen | {url}creativecommons org licen[cs]es by nc [1234] [05]
cc-by-nc-sa | tag | licen | {url}creativecommons org licen[cs]es by nc sa [1234] [05]
cc-by-nc-nd | tag | licen | {url}creativecommons org licen[cs]es by nc nd [1234] [05]
cc0 | tag | creativecommons | {url}creativecommons org publicdomain zero 1 0
public-domain | tag | creativecommons | {url}creativecommons org publicdomain mark 1 0
cc-by | name | cc  by | cc by(?: [1234] [05])?
cc-by-sa | name | cc  by | cc by sa(?: [1234] [05])?
cc-by-nd | name | cc  by | cc by nd(?: [1234] [05])?
cc-by-nc | name | cc  by | cc by nc(?: [1234] [05])?
cc-by-nc-sa | name | cc  by | cc by nc sa(?: [1234] [05])?
cc-by-nc-nd | name | cc  by | cc by nc nd(?: [1234] [05])?
cc-by-nc-nd | name | commons | creative commons attribution (?:non commercial|noncommercial) (?:no derivatives|noderivatives|noderivs|no derivs)
cc-by-nc-sa | name | commons | creative commons attribution (?:non commercial|noncommercial) (?:share alike|sharealike)
cc-by-nc | name | commons | creative commons attribution (?:non commercial|noncommercial)
cc-by-sa | name | commons | creative commons attribution (?:share alike|sharealike)
cc-by-nd | name | commons | creative commons attribution (?:no derivatives|noderivatives|noderivs|no derivs)
cc-by | name | commons | creative commons attribution
cc | name | commons | creative commons licen[cs]es?
cc0 | text | commons | the person who associated a work with this deed has dedicated the work to the public domain
cc0 | notice | cc0 | {under}cc0(?: 1 0)?
cc0 | notice | commons | {under}creative commons (?:zero|cc0)
cc0 | name | commons | creative commons (?:zero|cc0)
cc0 | name | cc0 | cc0(?: 1 0)?(?: universal)?
public-domain | notice | domain | (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain | notice | domain | (?:is|are) in the public domain
public-domain | notice | domain | public domain (?:dedication|mark|work|notice)
unlicense | text | domain | this is free and unencumbered software released into the public domain
unlicense | text | copyright | anyone is free to copy modify publish use compile sell or distribute this software
unlicense | notice | licen | {under}unlicense
unlicense | tag | licen | {spdx}unlicense
unlicense | tag | licen | {url}unlicense org
unlicense | name | licen | the unlicense
wtfpl | notice | wtfpl | {under}wtfpl
wtfpl | tag | licen | {spdx}wtfpl
wtfpl | name | licen | do what the fuck you want to public licen[cs]e
wtfpl | name | wtfpl | (?:the )?wtfpl(?: version 2)?
mpl-2 | text | licen | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | text | licen | the contents of this file are subject to the mozilla public license version 1 1
mpl-2 | notice | licen | {under}mozilla public licen[cs]e (?:version |v )?2(?: 0)?
mpl-1.1 | notice | licen | {under}mozilla public licen[cs]e (?:version |v )?1 1
mpl | notice | licen | {under}mozilla public licen[cs]e
mpl-2 | tag | licen | {spdx}mpl 2 0
mpl-1.1 | tag | licen | {spdx}mpl 1 1
mpl-2 | tag | mozilla | {url}mozilla org mpl 2 0
mpl-2 | name | licen | mozilla public licen[cs]e (?:version |v )?2(?: 0)?
mpl-1.1 | name | licen | mozilla public licen[cs]e (?:version |v )?1 1
mpl | name | licen | mozilla public licen[cs]e
epl-2 | notice | licen | {under}eclipse public licen[cs]e (?:version |v )?2(?: 0)?
epl-1 | notice | licen | {under}eclipse public licen[cs]e (?:version |v )?1(?: 0)?
epl | notice | licen | {under}eclipse public licen[cs]e
epl-2 | tag | licen | {spdx}epl 2 0
epl-1 | tag | licen | {spdx}epl 1 0
epl | tag | eclipse | {url}eclipse org legal epl (?:v10|v20|2 0)(?: html)?
epl-2 | name | licen | eclipse public licen[cs]e (?:version |v )?2(?: 0)?
epl-1 | name | licen | eclipse public licen[cs]e (?:version |v )?1(?: 0)?
epl | name | licen | eclipse public licen[cs]e
edl | name | licen | eclipse distribution licen[cs]e
cddl-1.0 | notice | licen | {under}common development and distribution licen[cs]e
cddl-1.0 | tag | licen | {spdx}cddl 1 [01]
cddl-1.0 | name | licen | common development and distribution licen[cs]e
cpl-1 | notice | licen | {under}common public licen[cs]e
cpl-1 | tag | licen | {spdx}cpl 1 0
cpl-1 | name | licen | common public licen[cs]e
ipl-1 | name | licen | ibm public licen[cs]e
eupl | notice | licen | {under}european union public licen[cs]e
eupl | tag | licen | {spdx}eupl 1 [012]
eupl | name | licen | european union public licen[cs]e
artistic-2 | notice | licen | {under}artistic licen[cs]e (?:version )?2(?: 0)?
artistic | notice | licen | {under}artistic licen[cs]e
artistic-2 | tag | licen | {spdx}artistic 2 0
artistic | tag | licen | {spdx}artistic 1 0
artistic | name | licen | artistic licen[cs]e
boost-1 | text | hereby  granted | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
boost-1 | notice | licen | {under}boost software licen[cs]e
boost-1 | tag | licen | {spdx}bsl 1 0
boost-1 | tag | licen | {url}boost org license 1 0 txt
boost-1 | name | licen | boost software licen[cs]e
zlib | text | warrant | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | text | permission | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | notice | licen | {under}zlib (?:libpng )?licen[cs]e
zlib | tag | licen | {spdx}zlib
zlib | name | licen | zlib (?:libpng )?licen[cs]e
openssl | text | redistribut | this product includes software developed by the openssl project
openssl | tag | licen | {spdx}openssl
openssl | name | licen | openssl licen[cs]e
php-3 | text | redistribut | this product includes php software freely available from
php-3 | tag | licen | {spdx}php 3 (?:0|01)
php-3 | name | licen | php licen[cs]e
python-2 | notice | licen | {under}(?:python software foundation|psf) licen[cs]e
python-2 | tag | licen | {spdx}(?:psf|python) 2 0
python-2 | name | licen | (?:python software foundation|psf) licen[cs]e
postgresql | tag | licen | {spdx}postgresql
postgresql | name | licen | postgresql licen[cs]e
ruby | name | licen | ruby licen[cs]e
w3c | notice | licen | {under}w3c (?:software )?(?:notice and )?licen[cs]e
w3c | tag | licen | {spdx}w3c
w3c | name | licen | w3c (?:software )?(?:notice and )?licen[cs]e
ofl-1.1 | text | licen | this font software is licensed under the sil open font license
ofl-1.1 | notice | licen | {under}(?:sil )?open font licen[cs]e
ofl-1.1 | tag | licen | {spdx}ofl 1 1
ofl-1.1 | name | licen | (?:sil )?open font licen[cs]e
odbl | notice | licen | {under}(?:odc )?open (?:data commons )?(?:open )?database licen[cs]e
odbl | tag | licen | {spdx}odbl 1 0
odbl | name | licen | open (?:data commons open )?database licen[cs]e
odc-by | name | licen | open data commons attribution licen[cs]e
pddl | name | domain | open data commons public domain dedication
ogl-uk | notice | licen | {under}open government licen[cs]e
ogl-uk | name | licen | open government licen[cs]e
etalab | name | licen | (?:licen[cs]e ouverte|etalab open licen[cs]e)
ms-pl | notice | licen | {under}microsoft public licen[cs]e
ms-pl | tag | licen | {spdx}ms pl
ms-pl | name | licen | microsoft public licen[cs]e
ms-rl | name | licen | microsoft reciprocal licen[cs]e
bsl-1.1 | notice | licen | {under}business source licen[cs]e
bsl-1.1 | tag | licen | {spdx}busl 1 1
bsl-1.1 | name | licen | business source licen[cs]e
sspl-1 | notice | licen | {under}server side public licen[cs]e
sspl-1 | tag | licen | {spdx}sspl 1 0
sspl-1 | name | licen | server side public licen[cs]e
elastic-2 | notice | licen | {under}elastic licen[cs]e
elastic-2 | name | licen | elastic licen[cs]e (?:version |v )?2(?: 0)?
openrail | notice | licen | {under}(?:creativeml |bigscience )?open ?rail(?: m)?
openrail | name | licen | (?:creativeml |bigscience )?openrail(?: m)? licen[cs]e
afl-3 | tag | licen | {spdx}afl 3 0
afl-3 | name | licen | academic free licen[cs]e
osl-3 | tag | licen | {spdx}osl 3 0
osl-3 | name | licen | open software licen[cs]e
apsl | name | licen | apple public source licen[cs]e
qpl-1 | name | licen | q public licen[cs]e
sleepycat | name | licen | sleepycat licen[cs]e
lppl | notice | licen | {under}latex project public licen[cs]e
lppl | name | licen | latex project public licen[cs]e
ecl-2 | name | licen | educational community licen[cs]e
upl-1 | name | licen | universal permissive licen[cs]e
ncsa | name | licen | (?:university of illinois )?ncsa (?:open source )?licen[cs]e
vim | name | licen | vim licen[cs]e
fal | name | licen | (?:free art licen[cs]e|licen[cs]e art libre)
cecill | notice | licen | {under}cecill (?:b |c )?licen[cs]e
cecill | name | licen | cecill (?:b |c )?licen[cs]e
commercial | notice | licen | (?:commercial|proprietary|enterprise) licen[cs]e (?:agreement|is required|required)
commercial | notice | licen | end user licen[cs]e agreement
commercial | name | copyright | all rights reserved (?:no part of|unauthori[sz]ed (?:copying|use|reproduction))
"""

#: What stands for a license by contract, by label; strongest of all, and never suppressed.
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def _needle(pattern: str) -> str:
    """The longest part of a pattern that stands outside groups and classes and isn't optional."""
    inside, parts = 0, [""]
    for k, c in enumerate(pattern):
        inside += c in "(["
        if inside or pattern[k + 1 : k + 2] in ("?", "{", "+") or not (c.isalnum() or c == " "):
            parts.append("")
        else:
            parts[-1] += c
        inside -= c in ")]"
    return max(parts, key=len)


def rules() -> list[Rule]:
    """All signatures in their order; the first ones are BASE."""
    lines = [(label, "base", "cc  by" if phrase.startswith("cc") else "licen", phrase) for label, phrase in BASE.items()]
    lines += [tuple(x.strip() for x in line.split("|", 3)) for line in TABLE.strip().splitlines()]
    out = []
    for k, (label, kind, keyword, pattern) in enumerate(lines):
        for name, part in PARTS.items():
            pattern = pattern.replace("{" + name + "}", part)
        regex = f" {pattern.replace(' ', '  ')} "
        out.append(Rule(k, label, KINDS.index(kind), keyword, max(_needle(regex), keyword, key=len), regex))
    return out
