"""Signature rules of the license scan, in order of precedence within a tier.

A rule is ``label ; keyword ; expression``.  Expressions see a text as words
with one space between them (ASCII letters lower-cased, everything but digits,
letters and non-ASCII characters a separator), start and end at word borders,
and may use: ``{L}`` license or licence, ``{LD}`` licensed or licenced, ``{V}``
an optional "version" or "v", ``{T}`` an optional "the", ``{G n}`` up to n
words of any kind.  The keyword's words stand side by side in every text that
the expression can match, so a text without them is never tried.
"""

from __future__ import annotations

import re

#: The contract's phrases.  They are never suppressed.
BASE = """
gpl ; gnu general public license ; gnu general public license
apache ; apache license ; apache license
cc-by ; cc by ; cc by
mit ; mit license ; mit license
"""

#: Words of the grant or of the conditions themselves.
NOTICES = """
mit ; permission is hereby granted free of charge ; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit ; deal in the software without restriction ; to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit ; in all copies or substantial portions ; the above copyright notice and this permission notice shall be included in all copies or substantial portions of {T}software
mit-0 ; permission is hereby granted free of charge ; permission is hereby granted free of charge to any person obtaining a copy{G 12} to deal in the software without restriction{G 24} to permit persons to whom the software is furnished to do so the software is provided
isc ; for any purpose with or without fee ; permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?: provided that)?
0bsd ; for any purpose with or without fee ; permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd-2-clause ; redistributions in binary form ; redistributions of source code must retain{G 14} redistributions in binary form must reproduce{G 22} this software is provided
bsd-3-clause ; to endorse or promote products ; neither the names? of {G 12}contributors may be used to endorse or promote products derived from this software
bsd-3-clause ; to endorse or promote products ; may not be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause ; advertising materials mentioning ; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd ; redistribution and use in source and binary ; redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?
bsd-3-clause-clear ; no express or implied licenses ; no express or implied licenses to any party s patent rights are granted by this {L}
bsd-3-clause-no-nuclear ; nuclear facility ; not designed{G 2} or intended for use in the design construction operation or maintenance of any nuclear facility
apache-2.0 ; apache license version 2 ; {LD} under the apache license version 2 0(?: the license)?(?: you may not use this file except in compliance with the license)?
apache-2.0 ; except in compliance with the license ; you may not use this (?:file|work|software) except in compliance with the license
apache-2.0 ; without warranties or conditions of any kind ; distributed on an as is basis without warranties or conditions of any kind either express or implied
apache-1.1 ; apache software foundation ; this product includes software developed by the apache software foundation
apache-1.0 ; apache group ; this product includes software developed by the apache group for use in the apache http server project
gpl-2.0 ; free software foundation ; gnu general public {L} as published by the free software foundation version 2
gpl-2.0-or-later ; any later version ; gnu general public {L} as published by the free software foundation either version 2 of the {L} or at your option any later version
gpl-3.0 ; free software foundation ; gnu general public {L} as published by the free software foundation version 3
gpl-3.0-or-later ; any later version ; gnu general public {L} as published by the free software foundation either version 3 of the {L} or at your option any later version
gpl ; redistribute it and or modify it ; this (?:program|file|library|software) is free software you can redistribute it and or modify it under the terms of the gnu general public {L}
gpl ; along with this program ; you should have received a copy of the gnu general public {L} along with this program
lgpl-2.0-or-later ; any later version ; gnu library general public {L} as published by the free software foundation either version 2 of the {L} or at your option any later version
lgpl-2.1 ; free software foundation ; gnu lesser general public {L} as published by the free software foundation version 2 1
lgpl-2.1-or-later ; any later version ; gnu lesser general public {L} as published by the free software foundation either version 2 1 of the {L} or at your option any later version
lgpl-3.0 ; free software foundation ; gnu lesser general public {L} as published by the free software foundation version 3
lgpl-3.0-or-later ; any later version ; gnu lesser general public {L} as published by the free software foundation either version 3 of the {L} or at your option any later version
lgpl ; gnu lesser general public ; redistribute it and or modify it under the terms of the gnu lesser general public {L}
agpl-3.0 ; gnu affero general public ; gnu affero general public {L} as published by the free software foundation version 3
agpl-3.0-or-later ; any later version ; gnu affero general public {L} as published by the free software foundation either version 3 of the {L} or at your option any later version
agpl ; gnu affero general public ; redistribute it and or modify it under the terms of the gnu affero general public {L}
gfdl ; free documentation ; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {L}
gfdl-1.3 ; free documentation ; under the terms of the gnu free documentation {L} version 1 3
gfdl-1.2 ; free documentation ; under the terms of the gnu free documentation {L} version 1 2
mpl-2.0 ; mozilla public ; this source code form is subject to the terms of the mozilla public {L} v 2 0
mpl-2.0 ; mozilla org mpl 2 0 ; if a copy of the mpl was not distributed with this file you can obtain one at https? mozilla org mpl 2 0
mpl-1.1 ; mozilla public ; the contents of this file are subject to the mozilla public {L} version 1 1
mpl-1.0 ; mozilla public ; the contents of this file are subject to the mozilla public {L} version 1 0
epl-1.0 ; eclipse public ; made available under the terms of the eclipse public {L} v ?1 0
epl-2.0 ; eclipse public ; made available under the terms of the eclipse public {L} (?:v ?)?2 0
cddl-1.0 ; common development and distribution ; subject to the terms of the common development and distribution {L}
unlicense ; released into the public domain ; this is free and unencumbered software released into the public domain
unlicense ; anyone is free to copy modify ; anyone is free to copy modify publish use compile sell or distribute this software
zlib ; altered source versions ; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib ; arising from the use of this software ; in no event will the authors be held liable for any damages arising from the use of this software
bsl-1.0 ; boost software ; distributed under the boost software {L} version 1 0
wtfpl ; do what the fuck ; everyone is permitted to copy and distribute verbatim or modified copies of this{G 20} do what the fuck you want to public {L}
artistic-2.0 ; artistic ; under the terms of the artistic {L} (?:version )?2 0
artistic-1.0 ; standard version of ; you may make and give away verbatim copies of the source form of the standard version of {T}package
perl ; same terms as perl ; you can redistribute it and or modify it under the same terms as perl(?: itself)?
ofl-1.1 ; sil open font ; this font software is {LD} under the sil open font {L} version 1 1
cc0-1.0 ; cc0 ; to the extent possible under law{G 12} waived all copyright and related or neighboring rights{G 20} cc0
cc0 ; waived all copyright ; has waived all copyright and related or neighboring rights to
cc-by ; creative commons attribution ; this work is {LD} under a creative commons attribution{G 4} {L}
python-2.0 ; python software foundation ; python software foundation {L} version 2
openssl ; openssl toolkit ; this product includes software developed by the openssl project for use in the openssl toolkit
public-domain ; public domain ; (?:placed|released|dedicated) (?:in|into|to) the public domain
public-domain ; public domain ; this (?:code|file|software|work|program) is in the public domain
proprietary ; all rights reserved ; this (?:software|document|material) is (?:proprietary|confidential){G 10} all rights reserved
proprietary ; strictly prohibited ; unauthorized (?:copying|use|reproduction|distribution){G 14} (?:is )?strictly prohibited
proprietary ; trade ; contains (?:proprietary|confidential) (?:information|and proprietary information){G 8} trade secrets?
proprietary ; without the prior written permission ; no part of this (?:document|publication|work|book) may be reproduced{G 16} without the prior written permission
commercial ; commercial ; requires? a (?:paid |separate )?commercial {L}
non-commercial ; non commercial ; for non commercial (?:use|purposes|research)(?: only)?
non-commercial ; noncommercial ; for noncommercial (?:use|purposes|research)(?: only)?
research-only ; research purposes only ; for (?:academic |scientific )?research purposes only
no-derivatives ; no derivative ; no derivative works?(?: are| is)? (?:permitted|allowed)
evaluation-only ; evaluation purposes ; for evaluation purposes only
warranty-disclaimer ; without warranty of any kind ; (?:is )?provided as is without warranty of any kind(?: express or implied)?
openrail ; use based restrictions ; use based restrictions{G 6} (?:as set forth|set forth|listed) in attachment a
"""

#: Addresses of license texts.
LINKS = """
apache-2.0 ; apache org licenses ; apache org licenses license 2 0
apache ; apache org licenses ; apache org licenses
mit ; opensource org ; opensource org licenses mit(?: license)?
bsd-2-clause ; opensource org ; opensource org licenses bsd 2 clause
bsd-3-clause ; opensource org ; opensource org licenses bsd 3 clause
isc ; opensource org ; opensource org licenses isc
apache-2.0 ; opensource org ; opensource org licenses apache 2 0
gpl-2.0 ; opensource org ; opensource org licenses gpl 2 0
gpl-3.0 ; opensource org ; opensource org licenses gpl 3 0
mpl-2.0 ; opensource org ; opensource org licenses mpl 2 0
osi ; opensource org ; opensource org licenses
gpl-2.0 ; gnu org ; gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 ; gnu org ; gnu org licenses gpl 3 0
gpl ; gnu org ; gnu org licenses gpl
lgpl-2.1 ; gnu org ; gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 ; gnu org ; gnu org licenses lgpl 3 0
lgpl ; gnu org ; gnu org licenses lgpl
agpl-3.0 ; gnu org ; gnu org licenses agpl 3 0
agpl ; gnu org ; gnu org licenses agpl
gfdl ; gnu org ; gnu org licenses fdl
gpl ; gnu org ; gnu org (?:copyleft|licenses)
mpl-2.0 ; mozilla org ; mozilla org mpl 2 0
mpl-1.1 ; mozilla org ; mozilla org mpl mpl 1 1
mpl ; mozilla org ; mozilla org mpl
epl-1.0 ; eclipse org ; eclipse org legal epl v10
epl-2.0 ; eclipse org ; eclipse org legal epl 2 0
unlicense ; unlicense org ; unlicense org
bsl-1.0 ; boost org ; boost org license 1 0 txt
wtfpl ; wtfpl net ; wtfpl net
ofl-1.1 ; scripts sil org ; scripts sil org ofl
cc0-1.0 ; creativecommons org ; creativecommons org publicdomain zero 1 0
public-domain ; creativecommons org ; creativecommons org publicdomain mark 1 0
cc-by-4.0 ; creativecommons org ; creativecommons org licenses by 4 0
cc-by-3.0 ; creativecommons org ; creativecommons org licenses by 3 0
cc-by-2.5 ; creativecommons org ; creativecommons org licenses by 2 5
cc-by-2.0 ; creativecommons org ; creativecommons org licenses by 2 0
cc-by-sa-4.0 ; creativecommons org ; creativecommons org licenses by sa 4 0
cc-by-sa-3.0 ; creativecommons org ; creativecommons org licenses by sa 3 0
cc-by-sa-2.0 ; creativecommons org ; creativecommons org licenses by sa 2 0
cc-by-nc-4.0 ; creativecommons org ; creativecommons org licenses by nc 4 0
cc-by-nc-3.0 ; creativecommons org ; creativecommons org licenses by nc 3 0
cc-by-nd-4.0 ; creativecommons org ; creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0 ; creativecommons org ; creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 ; creativecommons org ; creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 ; creativecommons org ; creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 ; creativecommons org ; creativecommons org licenses by nc nd 3 0
cc ; creativecommons org ; creativecommons org licenses
odbl-1.0 ; opendatacommons org ; opendatacommons org licenses odbl
odc-by-1.0 ; opendatacommons org ; opendatacommons org licenses by
pddl-1.0 ; opendatacommons org ; opendatacommons org licenses pddl
eupl ; joinup ec europa eu ; joinup ec europa eu{G 6} eupl
python-2.0 ; docs python org ; docs python org{G 2} license
"""

#: Names with a version or a variant.
VERSIONS = """
gpl-1.0 ; gnu general public ; gnu general public {L}{V} 1(?: 0)?
gpl-2.0-or-later ; later ; gnu general public {L}{V} 2(?: 0)? or (?:any )?later(?: version)?
gpl-2.0-or-later ; any later version ; gnu general public {L}{V} 2(?: 0)? or at your option any later version
gpl-2.0-only ; gnu general public ; gnu general public {L}{V} 2(?: 0)? only
gpl-2.0 ; gnu general public ; gnu general public {L}{V} 2(?: 0)?
gpl-3.0-or-later ; later ; gnu general public {L}{V} 3(?: 0)? or (?:any )?later(?: version)?
gpl-3.0-or-later ; any later version ; gnu general public {L}{V} 3(?: 0)? or at your option any later version
gpl-3.0-only ; gnu general public ; gnu general public {L}{V} 3(?: 0)? only
gpl-3.0 ; gnu general public ; gnu general public {L}{V} 3(?: 0)?
gpl-2.0 ; gplv2 ; gplv2
gpl-3.0 ; gplv3 ; gplv3
gpl-2.0-or-later ; gplv2 ; gplv2 or later
gpl-3.0-or-later ; gplv3 ; gplv3 or later
gpl-2.0 ; gpl ; gpl{V} 2(?: 0)?
gpl-3.0 ; gpl ; gpl{V} 3(?: 0)?
gpl-2.0-or-later ; gpl ; gpl{V} 2(?: 0)? or later
gpl-3.0-or-later ; gpl ; gpl{V} 3(?: 0)? or later
gpl-with-exception ; exception ; gnu general public {L}{G 5} with (?:the )?(?:classpath|linking|runtime library|font) exception
lgpl-2.0 ; gnu library general ; gnu library general public {L}{V} 2(?: 0)?
lgpl-2.1 ; gnu lesser general ; gnu lesser general public {L}{V} 2 1
lgpl-2.1-or-later ; later ; gnu lesser general public {L}{V} 2 1 or (?:any )?later(?: version)?
lgpl-3.0 ; gnu lesser general ; gnu lesser general public {L}{V} 3(?: 0)?
lgpl-3.0-or-later ; later ; gnu lesser general public {L}{V} 3(?: 0)? or (?:any )?later(?: version)?
lgpl-2.1 ; lgpl ; lgpl{V} 2 1
lgpl-3.0 ; lgpl ; lgpl{V} 3(?: 0)?
lgpl-3.0 ; lgplv3 ; lgplv3
lgpl-2.1 ; lgplv2 ; lgplv2 1
agpl-3.0 ; gnu affero ; gnu affero general public {L}{V} 3(?: 0)?
agpl-3.0 ; agplv3 ; agplv3
agpl-3.0 ; agpl ; agpl{V} 3(?: 0)?
agpl-1.0 ; affero general ; affero general public {L}{V} 1(?: 0)?
gfdl-1.1 ; free documentation ; gnu free documentation {L}{V} 1 1
gfdl-1.2 ; free documentation ; gnu free documentation {L}{V} 1 2
gfdl-1.3 ; free documentation ; gnu free documentation {L}{V} 1 3
apache-1.0 ; apache ; apache(?: software)? {L}{V} 1 0
apache-1.1 ; apache ; apache(?: software)? {L}{V} 1 1
apache-2.0 ; apache ; apache(?: software)? {L}{V} 2(?: 0)?
apache-2.0 ; apache ; apache 2 0(?: {L})?
apache-2.0 ; asl ; asl 2 0
apache-2.0-llvm ; llvm ; apache {L}{V} 2 0 with llvm exceptions?
mpl-1.0 ; mozilla public ; mozilla public {L}{V} 1 0
mpl-1.1 ; mozilla public ; mozilla public {L}{V} 1 1
mpl-2.0 ; mozilla public ; mozilla public {L}{V} 2(?: 0)?
mpl-2.0 ; mpl ; mpl{V} 2 0
mpl-1.1 ; mpl ; mpl{V} 1 1
npl-1.1 ; netscape public ; netscape public {L}{V} 1 1
epl-1.0 ; eclipse public ; eclipse public {L}{V} 1(?: 0)?
epl-2.0 ; eclipse public ; eclipse public {L}{V} 2(?: 0)?
edl-1.0 ; eclipse distribution ; eclipse distribution {L}{V} 1(?: 0)?
cpl-1.0 ; common public ; common public {L}{V} 1 0
ipl-1.0 ; ibm public ; ibm public {L}{V} 1 0
cddl-1.0 ; cddl ; cddl{V} 1 0
cddl-1.1 ; cddl ; cddl{V} 1 1
cddl-1.0 ; common development ; common development and distribution {L}{V} 1 0
bsd-2-clause ; bsd ; (?:2|two) clause bsd(?: {L})?
bsd-2-clause ; bsd ; bsd (?:2|two) clause(?: {L})?
bsd-3-clause ; bsd ; (?:3|three) clause bsd(?: {L})?
bsd-3-clause ; bsd ; bsd (?:3|three) clause(?: {L})?
bsd-4-clause ; bsd ; (?:4|four) clause bsd(?: {L})?
bsd-4-clause ; bsd ; bsd (?:4|four) clause(?: {L})?
0bsd ; bsd ; (?:0|zero) clause bsd(?: {L})?
0bsd ; bsd ; bsd (?:0|zero) clause(?: {L})?
bsd-2-clause ; simplified bsd ; simplified bsd {L}
bsd-2-clause ; freebsd license ; freebsd license
bsd-3-clause ; bsd ; (?:new|modified|revised) bsd {L}
bsd-4-clause ; bsd ; (?:original|old) bsd {L}
mit-0 ; mit ; mit no attribution(?: {L})?
x11 ; x11 ; x11 {L}
mit ; expat ; expat {L}
cc-by-4.0 ; cc by ; cc by 4 0
cc-by-3.0 ; cc by ; cc by 3 0
cc-by-sa-4.0 ; cc by sa ; cc by sa 4 0
cc-by-sa-3.0 ; cc by sa ; cc by sa 3 0
cc-by-sa ; cc by sa ; cc by sa
cc-by-nc-4.0 ; cc by nc ; cc by nc 4 0
cc-by-nc ; cc by nc ; cc by nc
cc-by-nc-sa-4.0 ; cc by nc sa ; cc by nc sa 4 0
cc-by-nc-sa ; cc by nc sa ; cc by nc sa
cc-by-nd ; cc by nd ; cc by nd(?: 4 0)?
cc-by-nc-nd-4.0 ; cc by nc nd ; cc by nc nd 4 0
cc-by-nc-nd ; cc by nc nd ; cc by nc nd
cc0-1.0 ; cc0 ; cc0 1 0(?: universal)?
cc-by-4.0 ; creative commons attribution ; creative commons attribution 4 0(?: international)?
cc-by-3.0 ; creative commons attribution ; creative commons attribution 3 0(?: unported)?
cc-by-sa-4.0 ; creative commons attribution ; creative commons attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0 ; creative commons attribution ; creative commons attribution share ?alike 3 0(?: unported)?
cc-by-sa ; creative commons attribution ; creative commons attribution share ?alike
cc-by-nc ; creative commons attribution ; creative commons attribution non ?commercial
cc-by-nc-sa ; creative commons attribution ; creative commons attribution non ?commercial share ?alike
cc-by-nd ; creative commons attribution ; creative commons attribution no ?derivatives
cc-by-nc-nd ; creative commons attribution ; creative commons attribution non ?commercial no ?derivatives
odbl-1.0 ; database ; open (?:data commons open )?database {L}{V} 1 0
artistic-1.0 ; artistic ; artistic {L}{V} 1 0
artistic-2.0 ; artistic ; artistic {L}{V} 2 0
bsl-1.0 ; boost software ; boost software {L}{V} 1 0
busl-1.1 ; business source ; business source {L}{V} 1 1
eupl-1.1 ; european union public ; european union public licen[cs]e{V} 1 1
eupl-1.2 ; european union public ; european union public licen[cs]e{V} 1 2
ofl-1.0 ; open font ; (?:sil )?open font {L}{V} 1 0
ofl-1.1 ; open font ; (?:sil )?open font {L}{V} 1 1
osl-3.0 ; open software ; open software {L}{V} 3 0
afl-3.0 ; academic free ; academic free {L}{V} 3 0
python-2.0 ; python ; python(?: software foundation)? {L}{V} 2(?: 0)?
php-3.01 ; php ; php {L}{V} 3 01
zpl-2.1 ; zope ; zope public {L}{V} 2 1
sspl-1.0 ; server side public ; server side public {L}{V} 1
elastic-2.0 ; elastic ; elastic {L}{V} 2 0
cecill-2.1 ; cecill ; cecill{V} 2 1
wtfpl-2.0 ; do what the fuck ; do what the fuck you want to public {L}{V} 2
llama ; llama ; llama (?:2|3|3 1) community {L}
openrail ; openrail ; (?:creativeml |bigscience )?openrail(?: m)?
"""

#: Names alone.
NAMES = """
gpl ; gnu general public ; gnu general public {L}
gpl ; gpl ; gpl {L}
gpl ; gnu gpl ; gnu gpl
lgpl ; lesser general public ; (?:gnu )?lesser general public {L}
lgpl ; library general public ; (?:gnu )?library general public {L}
lgpl ; lgpl ; (?:gnu )?lgpl(?: {L})?
agpl ; affero general public ; (?:gnu )?affero general public {L}
agpl ; agpl ; (?:gnu )?agpl(?: {L})?
gfdl ; free documentation ; (?:gnu )?free documentation {L}
apache ; apache ; apache (?:software |public )?{L}
apache ; apache ; {LD} under {T}apache
mit ; mit ; mit {L}
mit ; mit ; {LD} under {T}mit
mit ; mit ; mit {LD}
bsd ; bsd ; bsd {L}
bsd ; bsd ; bsd style {L}
bsd ; bsd ; {LD} under {T}bsd
isc ; isc ; isc {L}
mpl ; mozilla public ; mozilla public {L}
epl ; eclipse public ; eclipse public {L}
cddl ; common development ; common development and distribution {L}
cpl ; common public ; common public {L}
unlicense ; unlicense ; the unlicense
zlib ; zlib ; zlib {L}
libpng ; libpng ; libpng {L}
bsl-1.0 ; boost ; boost(?: software)? {L}
artistic ; artistic ; artistic {L}
wtfpl ; wtfpl ; wtfpl
cc ; creative commons ; creative commons(?: {L})?
cc0 ; cc0 ; cc0
cc-by ; creative commons attribution ; creative commons attribution(?: {L})?
odbl ; database ; open database {L}
ofl ; open font ; open font {L}
eupl ; european union public ; european union public licen[cs]e
osl ; open software ; open software {L}
afl ; academic free ; academic free {L}
python ; python ; python(?: software foundation)? {L}
php ; php ; php {L}
ruby ; ruby ; ruby {L}
zpl ; zope ; zope public {L}
ncsa ; ncsa ; (?:university of illinois )?ncsa(?: open source)? {L}
openssl ; openssl ; openssl {L}
postgresql ; postgresql ; postgresql {L}
vim ; vim ; vim {L}
beerware ; beerware ; beerware {L}
beerware ; beer ware ; beer ware {L}
sspl ; server side public ; server side public {L}
busl ; business source ; business source {L}
elastic ; elastic ; elastic {L}
cecill ; cecill ; cecill(?: {L})?
upl ; universal permissive ; universal permissive {L}
ms-pl ; microsoft public ; microsoft public {L}
ms-rl ; microsoft reciprocal ; microsoft reciprocal {L}
apsl ; apple public ; apple public source {L}
qpl ; q public ; q public {L}
sleepycat ; sleepycat ; sleepycat {L}
w3c ; w3c ; w3c(?: software)?(?: notice and)? {L}
unicode ; unicode ; unicode(?: inc)? {L}
icu ; icu ; icu {L}
json ; json ; json {L}
curl ; curl ; curl {L}
tcl ; tcl ; tcl(?: tk)? {L}
public-domain ; public domain ; public domain (?:dedication|{L}|software|work)
proprietary ; proprietary ; proprietary(?: software)? {L}
commercial ; commercial ; commercial(?: software)? {L}
eula ; end user ; end user {L} agreement
dual ; dual ; dual {LD}
dual ; dually ; dually {LD}
permissive ; permissive ; permissive(?: free)?(?: software)? {L}
copyleft ; copyleft ; copyleft {L}
"""

#: Identifiers that a tag line may name; one rule each is made from them.
TAGS = """
0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-2.0 bsd-2-clause bsd-3-clause
bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 cc0-1.0 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0
cc-by-sa-3.0 cc-by-sa-4.0 cddl-1.0 cecill-2.1 cpl-1.0 epl-1.0 epl-2.0 eupl-1.2 gfdl-1.3 gpl-2.0 gpl-2.0-only
gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later isc lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0
lgpl-3.0-only lgpl-3.0-or-later mit mit-0 mpl-1.1 mpl-2.0 ms-pl ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01
postgresql psf-2.0 python-2.0 sspl-1.0 unicode-dfs-2016 unlicense upl-1.0 vim wtfpl x11 zlib zpl-2.1
"""

#: Tier of a rule: how much a match says, and who suppresses whom (a lower tier is stronger).
NOTICE, TAG, VERSION, NAME = range(4)
CONFIDENCE = (1.0, 0.9, 0.75, 0.5)


def _expand(body: str) -> str:
    body = body.replace("{LD}", "licen[cs]ed").replace("{L}", "licen[cs]e").replace("{V} ", "(?: version| v)? v?").replace("{T}", "(?:the )?")
    return re.sub(r"\{G (\d+)\}", r"(?: [^ ]+){0,\1}", body)


def parse(lines: str, tier: int) -> list[tuple[str, int, str, str]]:
    """(label, tier, keyword, expression) of every line."""
    rules = []
    for line in filter(None, map(str.strip, lines.splitlines())):
        label, keyword, body = (x.strip() for x in line.split(" ; "))
        rules.append((label, tier, keyword, _expand(body)))
    return rules


def _tag_rules() -> list[tuple[str, int, str, str]]:
    words = lambda tag: re.sub(r"[^0-9a-z]+", " ", tag)
    return [(tag, TAG, "spdx license identifier", f"spdx license identifier {words(tag)}") for tag in TAGS.split()]


def standard_rules() -> list[tuple[str, int, str, str]]:
    """All rules in order; those of BASE come first."""
    return [
        *parse(BASE, NAME),
        *parse(NOTICES, NOTICE),
        *_tag_rules(),
        *parse(LINKS, TAG),
        *parse(VERSIONS, VERSION),
        *parse(NAMES, NAME),
    ]


N_BASE = len(parse(BASE, NAME))
