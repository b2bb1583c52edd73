"""Hand-written signature rules for licences, in order of precedence.

A rule is ``label; weight; keywords; pattern``. Patterns are regular expressions over a text's
words, lower-cased and joined by single spaces, and match whole words. ``LIC`` stands for the
spellings of "license", ``VER`` for an optional "version" or "v". A rule is tried only on texts
that have one of its keywords, which are parted by commas; every spelling of the pattern has one. Earlier sections are more specific: identifiers, then titles with versions,
then sentences of licence texts and notices, then bare names and general remarks.
"""

RULES = r"""
# Identifiers after a tag
apache-2.0; 1.0; spdx; spdx LIC identifier apache 2 0
apache-1.1; 1.0; spdx; spdx LIC identifier apache 1 1
mit; 1.0; spdx; spdx LIC identifier mit
mit-0; 1.0; spdx; spdx LIC identifier mit 0
bsd-2-clause; 1.0; spdx; spdx LIC identifier bsd 2 clause
bsd-3-clause; 1.0; spdx; spdx LIC identifier bsd 3 clause
bsd-4-clause; 1.0; spdx; spdx LIC identifier bsd 4 clause
0bsd; 1.0; spdx; spdx LIC identifier 0bsd
gpl-2.0-or-later; 1.0; spdx; spdx LIC identifier gpl 2 0 or later
gpl-2.0-only; 1.0; spdx; spdx LIC identifier gpl 2 0(?: only)?
gpl-3.0-or-later; 1.0; spdx; spdx LIC identifier gpl 3 0 or later
gpl-3.0-only; 1.0; spdx; spdx LIC identifier gpl 3 0(?: only)?
lgpl-2.1-or-later; 1.0; spdx; spdx LIC identifier lgpl 2 1 or later
lgpl-2.1-only; 1.0; spdx; spdx LIC identifier lgpl 2 1(?: only)?
lgpl-3.0-or-later; 1.0; spdx; spdx LIC identifier lgpl 3 0 or later
lgpl-3.0-only; 1.0; spdx; spdx LIC identifier lgpl 3 0(?: only)?
agpl-3.0-or-later; 1.0; spdx; spdx LIC identifier agpl 3 0 or later
agpl-3.0-only; 1.0; spdx; spdx LIC identifier agpl 3 0(?: only)?
mpl-1.1; 1.0; spdx; spdx LIC identifier mpl 1 1
mpl-2.0; 1.0; spdx; spdx LIC identifier mpl 2 0
epl-1.0; 1.0; spdx; spdx LIC identifier epl 1 0
epl-2.0; 1.0; spdx; spdx LIC identifier epl 2 0
cddl-1.0; 1.0; spdx; spdx LIC identifier cddl 1 0
eupl-1.2; 1.0; spdx; spdx LIC identifier eupl 1 2
isc; 1.0; spdx; spdx LIC identifier isc
zlib; 1.0; spdx; spdx LIC identifier zlib
bsl-1.0; 1.0; spdx; spdx LIC identifier bsl 1 0
busl-1.1; 1.0; spdx; spdx LIC identifier busl 1 1
sspl-1.0; 1.0; spdx; spdx LIC identifier sspl 1 0
unlicense; 1.0; spdx; spdx LIC identifier unlicense
wtfpl; 1.0; spdx; spdx LIC identifier wtfpl
artistic-2.0; 1.0; spdx; spdx LIC identifier artistic 2 0
ofl-1.1; 1.0; spdx; spdx LIC identifier ofl 1 1
cc0-1.0; 1.0; spdx; spdx LIC identifier cc0 1 0
cc-by-4.0; 1.0; spdx; spdx LIC identifier cc by 4 0
cc-by-sa-4.0; 1.0; spdx; spdx LIC identifier cc by sa 4 0
cc-by-nc-4.0; 1.0; spdx; spdx LIC identifier cc by nc 4 0
spdx-other; 0.8; spdx; spdx LIC identifier [a-z0-9]+(?: [0-9]+(?: [0-9]+)?)?

# Addresses of licence texts
apache-2.0; 0.95; apache; apache org LICs LIC 2 0(?: txt| html)?
gpl-3.0; 0.95; gnu; gnu org LICs gpl 3 0(?: [a-z]+)?
gpl-2.0; 0.95; gnu; gnu org LICs (?:old LICs )?gpl 2 0(?: [a-z]+)?
gpl; 0.9; gnu; gnu org LICs gpl(?: [a-z]+)?
lgpl; 0.9; gnu; gnu org LICs lgpl(?: [a-z]+)?
agpl-3.0; 0.95; gnu; gnu org LICs agpl(?: 3 0)?(?: [a-z]+)?
gfdl; 0.9; gnu; gnu org LICs fdl(?: [0-9 ]+)?(?: [a-z]+)?
gnu-other; 0.8; gnu; gnu org LICs
mit; 0.95; opensource; opensource org LICs mit(?: LIC)?
bsd; 0.9; opensource; opensource org LICs bsd(?: LIC| [234] clause)?
apache-2.0; 0.9; opensource; opensource org LICs apache 2 0
isc; 0.9; opensource; opensource org LICs isc
mpl-2.0; 0.95; mozilla; mozilla org mpl 2 0
mpl; 0.9; mozilla; mozilla org mpl
epl-2.0; 0.9; eclipse; eclipse org legal epl (?:2 0|v20)(?: html)?
epl-1.0; 0.9; eclipse; eclipse org legal epl v10(?: html)?
cc-by; 0.95; creativecommons; creativecommons org LICs by [1-4] [0-9]
cc-by-sa; 0.95; creativecommons; creativecommons org LICs by sa [1-4] [0-9]
cc-by-nd; 0.95; creativecommons; creativecommons org LICs by nd [1-4] [0-9]
cc-by-nc; 0.95; creativecommons; creativecommons org LICs by nc [1-4] [0-9]
cc-by-nc-sa; 0.95; creativecommons; creativecommons org LICs by nc sa [1-4] [0-9]
cc-by-nc-nd; 0.95; creativecommons; creativecommons org LICs by nc nd [1-4] [0-9]
cc0-1.0; 0.95; creativecommons; creativecommons org publicdomain zero 1 0
public-domain; 0.9; creativecommons; creativecommons org publicdomain mark 1 0
cc-other; 0.7; creativecommons; creativecommons org LICs
odbl; 0.9; opendatacommons; opendatacommons org LICs odbl(?: 1 0)?
odc-by; 0.9; opendatacommons; opendatacommons org LICs by(?: 1 0)?
pddl; 0.9; opendatacommons; opendatacommons org LICs pddl(?: 1 0)?
unlicense; 0.95; unlicense; unlicense org
wtfpl; 0.9; wtfpl; (?:www )?wtfpl net
ofl-1.1; 0.9; ofl; scripts sil org ofl

# Titles with versions
apache-2.0; 0.95; apache; apache(?: software)? LIC VER2(?: 0)?
apache-1.1; 0.95; apache; apache(?: software)? LIC VER1 1
apache-1.0; 0.95; apache; apache(?: software)? LIC VER1 0
apache-2.0; 0.9; apache; apache 2(?: 0)? LIC
apache-2.0; 0.85; asl; asl 2 0
gpl-3.0-or-later; 0.95; general; gnu general public LIC VER3(?: 0)?(?: of the LIC)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2.0-or-later; 0.95; general; gnu general public LIC VER2(?: 0)?(?: of the LIC)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0; 0.95; general; (?:gnu )?general public LIC VER3(?: 0)?
gpl-2.0; 0.95; general; (?:gnu )?general public LIC VER2(?: 0)?
gpl-1.0; 0.9; general; (?:gnu )?general public LIC VER1(?: 0)?
agpl-3.0; 0.95; affero; (?:gnu )?affero general public LIC VER3(?: 0)?
agpl-1.0; 0.9; affero; affero general public LIC VER1(?: 0)?
agpl; 0.9; affero; (?:gnu )?affero general public LIC
lgpl-3.0; 0.95; lesser; (?:gnu )?lesser general public LIC VER3(?: 0)?
lgpl-2.1; 0.95; lesser; (?:gnu )?lesser general public LIC VER2 1
lgpl; 0.9; lesser; (?:gnu )?lesser general public LIC
lgpl-2.0; 0.95; library; (?:gnu )?library general public LIC VER2(?: 0)?
lgpl; 0.9; library; (?:gnu )?library general public LIC
gfdl-1.3; 0.95; documentation; (?:gnu )?free documentation LIC VER1 3
gfdl-1.2; 0.95; documentation; (?:gnu )?free documentation LIC VER1 2
gfdl; 0.9; documentation; (?:gnu )?free documentation LIC
mpl-2.0; 0.95; mozilla; mozilla public LIC VER2(?: 0)?
mpl-1.1; 0.95; mozilla; mozilla public LIC VER1 1
mpl-1.0; 0.95; mozilla; mozilla public LIC VER1 0
epl-2.0; 0.95; eclipse; eclipse public LIC VER2(?: 0)?
epl-1.0; 0.95; eclipse; eclipse public LIC VER1(?: 0)?
edl-1.0; 0.95; eclipse; eclipse distribution LIC VER1(?: 0)?
cddl-1.1; 0.95; development; common development and distribution LIC(?: cddl)? VER1 1
cddl-1.0; 0.95; development; common development and distribution LIC(?: cddl)? VER1(?: 0)?
cpl-1.0; 0.95; common; common public LIC VER1(?: 0)?
cpal-1.0; 0.95; attribution; common public attribution LIC VER1(?: 0)?
ipl-1.0; 0.95; ibm; ibm public LIC VER1(?: 0)?
eupl-1.2; 0.95; european; european union public LICs? VER1 2
eupl-1.1; 0.95; european; european union public LICs? VER1 1
artistic-2.0; 0.95; artistic; artistic LIC VER2(?: 0)?
artistic-1.0; 0.95; artistic; artistic LIC VER1(?: 0)?
apsl-2.0; 0.95; apple; apple public source LIC VER2(?: 0)?
osl-3.0; 0.95; open; open software LIC(?: osl)? VER3(?: 0)?
afl-3.0; 0.95; academic; academic free LIC VER3(?: 0)?
afl-2.1; 0.95; academic; academic free LIC VER2 1
ecl-2.0; 0.95; educational; educational community LIC VER2(?: 0)?
bsl-1.0; 0.95; boost; boost software LIC VER1(?: 0)?
busl-1.1; 0.95; business; business source LIC VER1 1
elastic-2.0; 0.95; elastic; elastic LIC VER2(?: 0)?
sspl-1.0; 0.95; server; server side public LIC VER1(?: 0)?
upl-1.0; 0.95; permissive; universal permissive LIC VER1(?: 0)?
qpl-1.0; 0.9; q; q public LIC VER1(?: 0)?
php-3.01; 0.95; php; php LIC VER3 01
php-3.0; 0.95; php; php LIC VER3 0
python-2.0; 0.95; python; python(?: software foundation)? LIC VER2(?: 0)?
zpl-2.1; 0.95; zope; zope public LIC VER2 1
lppl-1.3c; 0.95; latex; latex project public LIC VER1 3c?
ofl-1.1; 0.95; sil; sil open font LIC VER1 1
ms-pl; 0.95; microsoft; microsoft public LIC
ms-rl; 0.95; microsoft; microsoft reciprocal LIC
mulan-2.0; 0.95; mulan; mulan permissive software LIC VER2
ncsa; 0.95; ncsa; university of illinois ncsa open source LIC
openssl; 0.9; openssl; openssl LIC
vim; 0.9; vim; vim LIC
ruby; 0.85; ruby; ruby LIC
w3c; 0.9; w3c; w3c software(?: and document)?(?: notice and)? LIC
unicode; 0.9; unicode; unicode LIC(?: agreement)?
icu; 0.9; icu; icu LIC
x11; 0.9; x11; x11 LIC
jsonl; 0.85; json; the json LIC
beerware; 0.95; beer, beerware; beer ?ware LIC
cecill-2.1; 0.95; cecill; cecill (?:free software )?LIC(?: agreement)? VER2 1
cecill; 0.85; cecill; cecill(?: b| c)? LIC
odbl-1.0; 0.95; database; open (?:data commons open )?database LIC VER1(?: 0)?
odbl; 0.9; database; open (?:data commons open )?database LIC
odc-by; 0.9; attribution; open data commons attribution LIC
ogl-3.0; 0.95; government; open government LIC VER3(?: 0)?
ogl; 0.9; government; open government LIC
cdla-permissive; 0.9; community; community data LIC agreement permissive
cdla-sharing; 0.9; community; community data LIC agreement sharing
openrail; 0.9; open, openrail; (?:creativeml |bigscience )?open ?rail(?: m)?(?: LIC)?
llama; 0.9; llama; llama [0-9 ]*community LIC(?: agreement)?

# Creative Commons, in words and in short
cc-by-nc-nd-4.0; 0.95; noncommercial; creative commons attribution noncommercial no ?deriv(?:ative)?(?:e)?s? 4 0(?: international)?
cc-by-nc-sa-4.0; 0.95; noncommercial; creative commons attribution noncommercial share ?alike 4 0(?: international)?
cc-by-nc-4.0; 0.95; noncommercial; creative commons attribution noncommercial 4 0(?: international)?
cc-by-nc-nd; 0.9; commons; creative commons attribution non ?commercial no ?deriv(?:ative)?(?:e)?s?
cc-by-nc-sa; 0.9; commons; creative commons attribution non ?commercial share ?alike
cc-by-nc; 0.9; commons; creative commons attribution non ?commercial
cc-by-nd-4.0; 0.95; commons; creative commons attribution no ?deriv(?:ative)?(?:e)?s? 4 0(?: international)?
cc-by-nd; 0.9; commons; creative commons attribution no ?deriv(?:ative)?(?:e)?s?
cc-by-sa-4.0; 0.95; commons; creative commons attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0; 0.95; commons; creative commons attribution share ?alike 3 0(?: unported)?
cc-by-sa; 0.9; commons; creative commons attribution share ?alike
cc-by-4.0; 0.95; commons; creative commons attribution 4 0(?: international)?
cc-by-3.0; 0.95; commons; creative commons attribution 3 0(?: unported)?
cc-by; 0.9; commons; creative commons attribution
cc0-1.0; 0.95; commons; creative commons (?:zero|cc0)(?: VER1 0)?(?: universal)?
cc0-1.0; 0.9; cc0; cc0(?: 1 0)?(?: universal)?
cc-by-nc-nd-4.0; 0.9; cc; cc by nc nd 4 0
cc-by-nc-nd; 0.85; cc; cc by nc nd
cc-by-nc-sa-4.0; 0.9; cc; cc by nc sa 4 0
cc-by-nc-sa; 0.85; cc; cc by nc sa
cc-by-nc-4.0; 0.9; cc; cc by nc 4 0
cc-by-nc; 0.85; cc; cc by nc
cc-by-nd-4.0; 0.9; cc; cc by nd 4 0
cc-by-nd; 0.85; cc; cc by nd
cc-by-sa-4.0; 0.9; cc; cc by sa 4 0
cc-by-sa-3.0; 0.9; cc; cc by sa 3 0
cc-by-sa; 0.85; cc; cc by sa
cc-by-4.0; 0.9; cc; cc by 4 0
cc-by-3.0; 0.9; cc; cc by 3 0
cc-by-2.0; 0.9; cc; cc by 2 0
cc-other; 0.7; commons; (?:under|by) (?:a|the) creative commons LIC

# Sentences of licence texts
mit; 0.95; hereby; permission is hereby granted free of charge to any person obtaining a copy
mit; 0.9; substantial; the above copyright notice and this permission notice shall be included in all copies or substantial portions
isc; 0.95; hereby; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd; 0.85; permission; permission to use copy modify and distribute this software and its documentation
bsd; 0.9; redistribution; redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause; 0.9; endorse; neither the name of .{1,120}? may be used to endorse or promote products
bsd-4-clause; 0.9; advertising; all advertising materials mentioning features or use of this software must display
bsd-2-clause; 0.8; redistributions; redistributions of source code must retain the above copyright notice
bsd-2-clause; 0.8; redistributions; redistributions in binary form must reproduce the above copyright notice
zlib; 0.9; misrepresented; the origin of this software must not be misrepresented
zlib; 0.85; altered; altered source versions must be plainly marked as such
bsl-1.0; 0.9; hereby; permission is hereby granted free of charge to any person or organization obtaining a copy
unlicense; 0.95; unencumbered; this is free and unencumbered software released into the public domain
wtfpl; 0.95; fuck; do what the fuck you want to(?: public LIC)?
apache-2.0; 0.9; compliance; you may not use this file except in compliance with the LIC
apache-2.0; 0.8; basis; distributed on an as is basis without warranties or conditions of any kind
gpl; 0.85; redistribute; this program is free software you can redistribute it and or modify it under the terms of
gpl; 0.8; merchantability; without even the implied warranty of merchantability or fitness for a particular purpose
gpl; 0.8; received; you should have received a copy of the gnu general public LIC
lgpl; 0.85; received; you should have received a copy of the gnu lesser general public LIC
lgpl; 0.85; library; this library is free software you can redistribute it
agpl; 0.85; received; you should have received a copy of the gnu affero general public LIC
mpl-2.0; 0.9; mozilla; this source code form is subject to the terms of the mozilla public LIC
epl; 0.85; eclipse; this program and the accompanying materials are made available under the terms of the eclipse public LIC
cddl; 0.85; development; the contents of this file are subject to the terms of the common development and distribution LIC
beerware; 0.9; beer; you can buy me a beer in return
ofl-1.1; 0.9; font; this font software is LICd under the sil open font LIC
no-warranty; 0.4; warranty; (?:is )?provided as is without (?:any )?(?:express or implied )?warranty
no-liability; 0.4; liable; in no event shall .{1,80}? be liable for any

# Notices and bare names
mit; 0.85; mit; (?:the )?mit LIC
mit; 0.8; mit; LICd under (?:the )?(?:terms of (?:the )?)?mit
bsd-3-clause; 0.9; bsd; (?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|revised bsd|modified bsd)(?: LIC)?
bsd-2-clause; 0.9; bsd, freebsd; (?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: LIC)?
bsd-4-clause; 0.9; bsd; (?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)(?: LIC)?
bsd; 0.8; bsd; bsd(?: style)? LIC
apache-2.0; 0.8; apache; LICd under (?:the )?apache(?: 2 0)?
apache; 0.7; apache; apache LIC
gpl-3.0-or-later; 0.85; gplv3; gplv3 (?:or later|plus)
gpl-2.0-or-later; 0.85; gplv2; gplv2 (?:or later|plus)
gpl-3.0; 0.85; gplv3; gplv3
gpl-2.0; 0.85; gplv2; gplv2
gpl-3.0; 0.8; gpl; gpl VER3(?: 0)?
gpl-2.0; 0.8; gpl; gpl VER2(?: 0)?
gpl; 0.7; gpl; (?:gnu )?gpl(?: LIC)?
lgpl-2.1; 0.85; lgpl; lgpl VER2 1
lgpl-3.0; 0.85; lgpl; lgpl VER3(?: 0)?
lgpl; 0.7; lgpl; (?:gnu )?lgpl(?: LIC)?
agpl-3.0; 0.85; agpl; agpl VER3(?: 0)?
agpl; 0.7; agpl; (?:gnu )?agpl(?: LIC)?
mpl-2.0; 0.85; mpl; mpl VER2(?: 0)?
mpl; 0.7; mozilla; mozilla public LIC
epl; 0.7; eclipse; eclipse public LIC
eupl; 0.7; european; european union public LICs?
artistic; 0.7; artistic; (?:the )?(?:perl )?artistic LIC
isc; 0.8; isc; isc LIC
zlib; 0.8; zlib; zlib(?: libpng)? LIC
boost; 0.8; boost; boost software LIC
python; 0.75; python; python software foundation LIC
wtfpl; 0.85; wtfpl; wtfpl
unlicense; 0.85; unlicense; (?:the )?unlicense
ofl; 0.8; font; (?:sil )?open font LIC
sspl; 0.85; server; server side public LIC
busl; 0.85; business; business source LIC
commons-clause; 0.9; clause; commons clause(?: LIC| condition)?
polyform; 0.9; polyform; polyform (?:noncommercial|shield|small business|strict|perimeter)(?: LIC)?
prosperity; 0.9; prosperity; prosperity public LIC
parity; 0.9; parity; parity public LIC
dual; 0.6; dual; dual LICd(?: under)?
same-terms; 0.5; perl; under the same terms as perl(?: itself)?

# Rights in general
gpl; 0.6; general; general public LIC
cc-by; 0.6; cc; cc by
reserved; 0.6; reserved; all rights(?: are)? reserved
reserved; 0.6; réservés; tous droits réservés
reserved; 0.6; reservados; todos los derechos reservados
reserved; 0.6; vorbehalten; alle rechte vorbehalten
reserved; 0.5; reserved; (?:some|no|certain) rights reserved
public-domain; 0.8; domain; (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain; 0.7; domain; (?:is|are) in the public domain
public-domain; 0.6; domaine; (?:dans le )?domaine public
public-domain; 0.6; dominio; (?:de )?dominio público
public-domain; 0.6; gemeinfrei; gemeinfrei
proprietary; 0.7; proprietary; proprietary and confidential
proprietary; 0.7; unauthorized; unauthorized (?:copying|use|reproduction|distribution)(?: or [a-z]+)? of this (?:file|software|material|document)
proprietary; 0.6; permission; (?:may not be|not to be) (?:copied|reproduced|distributed|redistributed)(?: or [a-z]+)? without (?:the )?(?:prior |express )?(?:written )?permission
non-commercial; 0.6; commercial, noncommercial; for non ?commercial (?:use|purposes)(?: only)?
personal-use; 0.6; personal; for personal use only
eula; 0.7; eula, agreement; end user LIC agreement|eula
copyleft; 0.5; copyleft; copyleft
copyright; 0.3; copyright; copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*
copyright; 0.3; ©, ©(?:19|20)[0-9]{2}; (?:copyright )?© ?(?:19|20)[0-9]{2}
permission; 0.3; reprinted; reprinted (?:with|by) permission(?: of)?
"""
