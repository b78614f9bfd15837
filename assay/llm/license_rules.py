"""Signature rules of licenses, written by hand, in order of priority.

One rule a line: label; score; keywords, of which a text must hold one, each alternative having
its own; regex over lower-case words parted by single spaces. {l} stands for "license" in both
spellings, {v} for how a version is led in. Grants and full headers come before names,
versions before families, so that the more telling rule wins where rules overlap.
"""

from __future__ import annotations

RULES = r"""
apache-2.0; 1.0; spdx; spdx {l} identifier apache 2 0
mit; 1.0; spdx; spdx {l} identifier mit
mit-0; 1.0; spdx; spdx {l} identifier mit 0
bsd-2-clause; 1.0; spdx; spdx {l} identifier bsd 2 clause
bsd-3-clause; 1.0; spdx; spdx {l} identifier bsd 3 clause
bsd-4-clause; 1.0; spdx; spdx {l} identifier bsd 4 clause
0bsd; 1.0; spdx; spdx {l} identifier 0bsd
isc; 1.0; spdx; spdx {l} identifier isc
zlib; 1.0; spdx; spdx {l} identifier zlib
boost-1.0; 1.0; spdx; spdx {l} identifier bsl 1 0
gpl-2.0; 1.0; spdx; spdx {l} identifier gpl 2 0(?: only)?
gpl-2.0-or-later; 1.0; spdx; spdx {l} identifier gpl 2 0 or later
gpl-3.0; 1.0; spdx; spdx {l} identifier gpl 3 0(?: only)?
gpl-3.0-or-later; 1.0; spdx; spdx {l} identifier gpl 3 0 or later
lgpl-2.1; 1.0; spdx; spdx {l} identifier lgpl 2 1(?: only| or later)?
lgpl-3.0; 1.0; spdx; spdx {l} identifier lgpl 3 0(?: only| or later)?
agpl-3.0; 1.0; spdx; spdx {l} identifier agpl 3 0(?: only| or later)?
mpl-2.0; 1.0; spdx; spdx {l} identifier mpl 2 0
mpl-1.1; 1.0; spdx; spdx {l} identifier mpl 1 1
epl-1.0; 1.0; spdx; spdx {l} identifier epl 1 0
epl-2.0; 1.0; spdx; spdx {l} identifier epl 2 0
eupl-1.2; 1.0; spdx; spdx {l} identifier eupl 1 2
cddl-1.0; 1.0; spdx; spdx {l} identifier cddl 1 0
artistic-2.0; 1.0; spdx; spdx {l} identifier artistic 2 0
unlicense; 1.0; spdx; spdx {l} identifier unlicense
wtfpl; 1.0; spdx; spdx {l} identifier wtfpl
psf-2.0; 1.0; spdx; spdx {l} identifier (?:psf|python) 2 0
cc0-1.0; 1.0; spdx; spdx {l} identifier cc0 1 0
cc-by-4.0; 1.0; spdx; spdx {l} identifier cc by 4 0
cc-by-3.0; 1.0; spdx; spdx {l} identifier cc by 3 0
cc-by-sa-4.0; 1.0; spdx; spdx {l} identifier cc by sa 4 0
cc-by-sa-3.0; 1.0; spdx; spdx {l} identifier cc by sa 3 0
cc-by-nc-4.0; 1.0; spdx; spdx {l} identifier cc by nc 4 0
cc-by-nd-4.0; 1.0; spdx; spdx {l} identifier cc by nd 4 0
cc-by-nc-sa-4.0; 1.0; spdx; spdx {l} identifier cc by nc sa 4 0
cc-by-nc-nd-4.0; 1.0; spdx; spdx {l} identifier cc by nc nd 4 0
ofl-1.1; 1.0; spdx; spdx {l} identifier ofl 1 1
ms-pl; 1.0; spdx; spdx {l} identifier ms pl
odbl-1.0; 1.0; spdx; spdx {l} identifier odbl 1 0
upl-1.0; 1.0; spdx; spdx {l} identifier upl 1 0
ncsa; 1.0; spdx; spdx {l} identifier ncsa
bsl-1.1; 1.0; spdx; spdx {l} identifier busl 1 1
mit; 0.95; permission is hereby granted; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit; 0.9; without restriction; to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
mit; 0.8; shall be included; the above copyright notice and this permission notice shall be included in all copies or substantial portions
boost-1.0; 0.95; permission is hereby granted; permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
ofl-1.1; 0.95; font software; permission is hereby granted free of charge to any person obtaining a copy of the font software
isc; 0.95; permission to use; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?: provided that the above copyright notice)?
0bsd; 0.6; and or distribute; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
historical; 0.85; permission to use; permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without (?:fee|written agreement)
bsd; 0.9; redistribution and use; redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?
bsd; 0.8; redistributions of source; redistributions of source code must retain the above copyright notice this list of conditions
bsd; 0.8; redistributions in binary; redistributions in binary form must reproduce the above copyright notice
bsd-3-clause; 0.85; endorse or promote; neither the names? of .{1,80}? may be used to endorse or promote products derived from this software
bsd-4-clause; 0.9; advertising materials; all advertising materials mentioning features or use of this software must display
apache-2.0; 0.95; apache; licensed under the apache {l} {v}2 0 the {l} you may not use this file except in compliance
apache-2.0; 0.95; apache; (?:sub|re|dual )?licensed (?:to you )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?apache(?: software)?(?: {l})? {v}2(?: 0)?
apache-2.0; 0.8; you may obtain; you may obtain a copy of the {l} at http www apache org licenses {l} 2 0
apache-2.0; 0.6; irrevocable; grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) {l}
gpl-3.0-or-later; 0.95; either version 3; gnu general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
gpl-2.0-or-later; 0.95; either version 2; gnu general public {l} as published by the free software foundation either version 2 of the {l} or at your option any later version
gpl-2.0; 0.95; version 2; gnu general public {l} version 2 (?:only )?as published by the free software foundation
gpl-3.0; 0.95; version 3; gnu general public {l} version 3 (?:only )?as published by the free software foundation
lgpl-2.1; 0.95; either version 2; gnu (?:lesser|library) general public {l} as published by the free software foundation either version 2(?: 1)? of the {l} or at your option any later version
lgpl-3.0; 0.95; either version 3; gnu lesser general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
agpl-3.0; 0.95; either version 3; gnu affero general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
gpl; 0.8; free software; this program is free software you can redistribute it and or modify it under the terms of the gnu general public {l}
lgpl; 0.8; free software; this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public {l}
gpl; 0.6; without any warranty; (?:program|software) is distributed in the hope that it will be useful but without any warranty
gpl; 0.7; you should have received; you should have received a copy of the gnu general public {l}
lgpl; 0.7; you should have received; you should have received a copy of the gnu (?:lesser|library) general public {l}
agpl; 0.7; you should have received; you should have received a copy of the gnu affero general public {l}
mpl-2.0; 0.95; mozilla; this source code form is subject to the terms of the mozilla public {l} v 2 0
mpl-1.1; 0.95; mozilla; the contents of this file are subject to the mozilla public {l} version 1 1
epl-2.0; 0.95; eclipse; made available under the terms of the eclipse public {l} (?:{v})?2(?: 0)?
epl-1.0; 0.95; eclipse; made available under the terms of the eclipse public {l} {v}1(?: 0)?
cddl-1.0; 0.95; common development; subject to the terms of the common development and distribution {l}
unlicense; 0.95; unencumbered; this is free and unencumbered software released into the public domain
unlicense; 0.8; unlicense; refer to http unlicense org
wtfpl; 0.95; what the; do what the fuck you want to(?: public {l})?
zlib; 0.95; express or implied; this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib; 0.8; altered source; altered source versions must be plainly marked as such
upl-1.0; 0.9; larger work; a copy of this software associated documentation and or data collectively the software .{0,80}larger work
cc0-1.0; 0.95; waived; to the extent possible under law .{1,80}? (?:has|have) waived all copyright
public-domain; 0.9; public domain; (?:has been |is |was )?(?:dedicated|released|placed) (?:to|into|in) the public domain
public-domain; 0.6; public domain; (?:is|are|now) in the public domain
public-domain; 0.5; public domain; public domain (?:work|software|dedication|mark|notice|text|book)
cc-by-nc-nd-4.0; 0.9; noncommercial, non commercial; creative commons attribution non ?commercial no ?deriv(?:ative|ativ)?(?:s|es|e works)? 4 0(?: international)?(?: public)?(?: {l})?
cc-by-nc-nd; 0.8; noncommercial, non commercial; creative commons attribution non ?commercial no ?deriv(?:ative|ativ)?(?:s|es|e works)?(?: [123] [0-9])?(?: unported| generic)?(?: {l})?
cc-by-nc-sa-4.0; 0.9; noncommercial, non commercial; creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: public)?(?: {l})?
cc-by-nc-sa; 0.8; noncommercial, non commercial; creative commons attribution non ?commercial share ?alike(?: [123] [0-9])?(?: unported| generic)?(?: {l})?
cc-by-nc-4.0; 0.9; noncommercial, non commercial; creative commons attribution non ?commercial 4 0(?: international)?(?: public)?(?: {l})?
cc-by-nc; 0.8; noncommercial, non commercial; creative commons attribution non ?commercial(?: [123] [0-9])?(?: unported| generic)?(?: {l})?
cc-by-nd-4.0; 0.9; creative commons; creative commons attribution no ?deriv(?:ative|ativ)?(?:s|es|e works)? 4 0(?: international)?(?: public)?(?: {l})?
cc-by-nd; 0.8; creative commons; creative commons attribution no ?deriv(?:ative|ativ)?(?:s|es|e works)?(?: [123] [0-9])?(?: unported| generic)?(?: {l})?
cc-by-sa-4.0; 0.9; creative commons; creative commons attribution share ?alike 4 0(?: international)?(?: public)?(?: {l})?
cc-by-sa-3.0; 0.9; creative commons; creative commons attribution share ?alike 3 0(?: unported| igo)?(?: {l})?
cc-by-sa; 0.8; creative commons; creative commons attribution share ?alike(?: [12] [0-9])?(?: {l})?
cc-by-4.0; 0.9; creative commons; creative commons attribution 4 0(?: international)?(?: public)?(?: {l})?
cc-by-3.0; 0.9; creative commons; creative commons attribution 3 0(?: unported| igo)?(?: {l})?
cc-by-2.0; 0.9; creative commons; creative commons attribution 2 [05](?: generic)?(?: {l})?
cc-by; 0.8; creative commons; creative commons attribution(?: international| unported| generic)?(?: public)? {l}
cc-by-4.0; 0.8; attribution; attribution 4 0 international
cc-by-sa-4.0; 0.8; attribution; attribution share ?alike 4 0 international
cc-by-nc-4.0; 0.8; attribution; attribution non ?commercial 4 0 international
cc0-1.0; 0.9; cc0, zero; (?:creative commons )?(?:cc0|zero)(?: {l})? (?:{v})?1 0(?: universal)?(?: public domain dedication)?
cc0-1.0; 0.7; cc0; (?:creative commons )?cc0(?: public domain(?: dedication)?| {l}| waiver)?
cc-by-nc-nd-4.0; 0.85; cc by nc nd; cc by nc nd(?: {l})? (?:{v})?4(?: 0)?
cc-by-nc-nd-3.0; 0.85; cc by nc nd; cc by nc nd(?: {l})? (?:{v})?3(?: 0)?
cc-by-nc-nd; 0.7; cc by nc nd; cc by nc nd
cc-by-nc-sa-4.0; 0.85; cc by nc sa; cc by nc sa(?: {l})? (?:{v})?4(?: 0)?
cc-by-nc-sa-3.0; 0.85; cc by nc sa; cc by nc sa(?: {l})? (?:{v})?3(?: 0)?
cc-by-nc-sa; 0.7; cc by nc sa; cc by nc sa
cc-by-nc-4.0; 0.85; cc by nc; cc by nc(?: {l})? (?:{v})?4(?: 0)?
cc-by-nc-3.0; 0.85; cc by nc; cc by nc(?: {l})? (?:{v})?3(?: 0)?
cc-by-nc; 0.7; cc by nc; cc by nc
cc-by-nd-4.0; 0.85; cc by nd; cc by nd(?: {l})? (?:{v})?4(?: 0)?
cc-by-nd-3.0; 0.85; cc by nd; cc by nd(?: {l})? (?:{v})?3(?: 0)?
cc-by-nd; 0.7; cc by nd; cc by nd
cc-by-sa-4.0; 0.85; cc by sa; cc by sa(?: {l})? (?:{v})?4(?: 0)?
cc-by-sa-3.0; 0.85; cc by sa; cc by sa(?: {l})? (?:{v})?3(?: 0)?
cc-by-sa; 0.7; cc by sa; cc by sa
cc-by-4.0; 0.85; cc by, ccby; cc ?by(?: {l})? (?:{v})?4(?: 0)?
cc-by-3.0; 0.85; cc by, ccby; cc ?by(?: {l})? (?:{v})?3(?: 0)?
cc-by-2.0; 0.85; cc by, ccby; cc ?by(?: {l})? (?:{v})?2(?: [05])?
cc-by-4.0; 0.8; creativecommons; creativecommons org licenses by 4 0
cc-by-3.0; 0.8; creativecommons; creativecommons org licenses by 3 0
cc-by-sa-4.0; 0.8; creativecommons; creativecommons org licenses by sa 4 0
cc-by-sa-3.0; 0.8; creativecommons; creativecommons org licenses by sa 3 0
cc-by-nc-4.0; 0.8; creativecommons; creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0; 0.8; creativecommons; creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0; 0.8; creativecommons; creativecommons org licenses by nc nd 4 0
cc-by-nd-4.0; 0.8; creativecommons; creativecommons org licenses by nd 4 0
cc0-1.0; 0.8; creativecommons; creativecommons org publicdomain zero 1 0
creative-commons; 0.5; creative commons; (?:under|with|by) (?:an? |the )?creative commons(?: {l})?
creative-commons; 0.5; creative commons; creative commons(?: public)? {l}
agpl-3.0; 0.8; affero; (?:gnu )?affero general public {l} (?:{v})?3(?: 0)?(?: only| or later| or newer)?
agpl; 0.6; affero; (?:gnu )?affero (?:general public {l}|gpl)
agpl-3.0; 0.8; agpl; (?:gnu )?agpl(?: {l})? (?:{v})?3(?: 0)?(?: only| or later| or newer)?
agpl-3.0; 0.8; agplv3, agpl3; (?:gnu )?agplv?3(?: 0| or later)?
agpl; 0.6; agpl; (?:gnu )?agpl(?: {l}| licensed)
lgpl-3.0; 0.8; lesser; (?:gnu )?lesser general public {l} (?:{v})?3(?: 0)?(?: only| or later| or newer)?
lgpl-2.1; 0.8; lesser; (?:gnu )?lesser general public {l} (?:{v})?2(?: 1)?(?: only| or later| or newer)?
lgpl-2.0; 0.8; library; (?:gnu )?library general public {l} (?:{v})?2(?: 0)?(?: only| or later| or newer)?
lgpl; 0.6; lesser, library; (?:gnu )?(?:lesser|library) (?:general public {l}|gpl)
lgpl-3.0; 0.8; lgpl; (?:gnu )?lgpl(?: {l})? (?:{v})?3(?: 0)?(?: only| or later| or newer)?
lgpl-2.1; 0.8; lgpl; (?:gnu )?lgpl(?: {l})? (?:{v})?2 1(?: only| or later| or newer)?
lgpl-2.0; 0.75; lgpl; (?:gnu )?lgpl(?: {l})? (?:{v})?2(?: 0)?(?: only| or later| or newer)?
lgpl-3.0; 0.8; lgplv3, lgpl3; (?:gnu )?lgplv?3(?: 0| or later)?
lgpl-2.1; 0.8; lgplv2, lgpl2; (?:gnu )?lgplv?2(?: 1)?(?: or later)?
lgpl; 0.6; lgpl; (?:gnu )?lgpl(?: {l}| licensed)
lgpl; 0.6; lgpl; (?:under|licen[cs]e|licensed) (?:the )?(?:gnu )?lgpl
gfdl; 0.8; documentation; gnu free documentation {l}(?: (?:{v})?1 [123])?
gfdl; 0.6; gfdl; (?:gnu )?gfdl(?: 1 [123])?
gpl-3.0; 0.8; general public; (?:gnu )?general public {l} (?:{v})?3(?: 0)?(?: only)?
gpl-3.0-or-later; 0.85; general public; (?:gnu )?general public {l} (?:{v})?3(?: 0)? or (?:any )?(?:later|newer)(?: version)?
gpl-2.0; 0.8; general public; (?:gnu )?general public {l} (?:{v})?2(?: 0)?(?: only)?
gpl-2.0-or-later; 0.85; general public; (?:gnu )?general public {l} (?:{v})?2(?: 0)? or (?:any )?(?:later|newer)(?: version)?
gpl-1.0; 0.8; general public; (?:gnu )?general public {l} (?:{v})1(?: 0)?
gpl-3.0-or-later; 0.85; gpl; (?:gnu )?gpl(?: {l})? (?:{v})?3(?: 0)? (?:or|and) (?:any )?(?:later|newer)(?: version)?
gpl-3.0; 0.8; gpl; (?:gnu )?gpl(?: {l})? (?:{v})?3(?: 0)?(?: only)?
gpl-2.0-or-later; 0.85; gpl; (?:gnu )?gpl(?: {l})? (?:{v})?2(?: 0)? (?:or|and) (?:any )?(?:later|newer)(?: version)?
gpl-2.0; 0.8; gpl; (?:gnu )?gpl(?: {l})? (?:{v})?2(?: 0)?(?: only)?
gpl-3.0; 0.8; gplv3, gpl3; (?:gnu )?gplv?3(?: 0)?(?: only| {l})?
gpl-3.0-or-later; 0.85; gplv3, gpl3; (?:gnu )?gplv?3(?: 0)? or (?:later|newer)
gpl-2.0; 0.8; gplv2, gpl2; (?:gnu )?gplv?2(?: 0)?(?: only| {l})?
gpl-2.0-or-later; 0.85; gplv2, gpl2; (?:gnu )?gplv?2(?: 0)? or (?:later|newer)
gpl; 0.6; gnu; gnu general public {l}
gpl; 0.6; gpl; (?:gnu gpl|gpl {l}|gpl licensed)
gpl; 0.6; gpl; (?:under|licen[cs]e|licensed) (?:the )?(?:gnu )?gpl
apache-2.0; 0.8; apache; (?:released|distributed|published|available|provided|covered|offered|open sourced) (?:only )?under (?:the )?(?:terms of (?:the )?)?apache(?: software)?(?: {l})? {v}2(?: 0)?
apache-2.0; 0.7; apache; apache(?: software)? {l} (?:{v})?2(?: 0)?
apache-2.0; 0.7; apache; apache (?:{v})?2(?: 0)?(?: {l}| licensed)
apache-2.0; 0.7; apache; {l} apache (?:{v})?2(?: 0)?
apache-2.0; 0.6; apache, asl; (?:apache|asl) 2 0
apache-2.0; 0.7; apache2, asl2; (?:apache2|asl2)(?: 0)?(?: {l})?
apache-1.1; 0.7; apache; apache(?: software)? {l} {v}1 1
apache; 0.5; apache; apache(?: software)?(?: foundation)? {l}
mit; 0.85; mit; (?:sub|re|dual )?licensed under (?:the )?(?:terms of (?:the )?)?mit(?: {l})?
mit; 0.8; mit; (?:released|distributed|published|available|provided|covered|offered|open sourced) (?:only )?under (?:the )?(?:terms of (?:the )?)?mit(?: {l})?
mit; 0.7; mit; mit(?: style| x11)? {l}
mit; 0.7; mit; (?:{l}|license type|license is) mit
mit; 0.6; mit; mit licensed
mit; 0.7; expat; expat {l}
x11; 0.7; x11; x11 {l}
bsd-3-clause; 0.8; bsd; (?:bsd 3(?: clause)?|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: {l}| licensed)?
bsd-2-clause; 0.8; bsd; (?:bsd 2(?: clause)?|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: {l}| licensed)
bsd-2-clause; 0.7; bsd; (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)
bsd-4-clause; 0.8; bsd; (?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: {l})?
0bsd; 0.8; bsd; (?:zero clause bsd|bsd zero clause|0 clause bsd|0bsd)(?: {l})?
bsd; 0.6; bsd; bsd(?: style| type| like)? {l}
bsd; 0.6; bsd; (?:{l} bsd|bsd licensed|under (?:the )?bsd)
isc; 0.7; isc; (?:isc {l}|{l} isc|under (?:the )?isc)
zlib; 0.7; zlib; (?:zlib(?: libpng)? {l}|{l} zlib|under (?:the )?zlib)
boost-1.0; 0.8; boost; boost software {l}(?: (?:{v})?1(?: 0)?)?
boost-1.0; 0.6; boost, bsl; (?:boost {l}|bsl 1 0)
mpl-2.0; 0.8; mozilla; mozilla public {l} (?:{v})?2(?: 0)?
mpl-1.1; 0.8; mozilla; mozilla public {l} (?:{v})?1(?: [01])?
mpl; 0.6; mozilla; mozilla public {l}
mpl-2.0; 0.8; mpl; mpl (?:{v})?2(?: 0)?
mpl-2.0; 0.8; mplv2, mpl2; mplv?2(?: 0)?
mpl-1.1; 0.8; mpl; mpl (?:{v})?1 [01]
mpl; 0.5; mpl; (?:mpl {l}|{l} mpl|under (?:the )?mpl)
epl-2.0; 0.8; eclipse; eclipse public {l} (?:{v})?2(?: 0)?
epl-1.0; 0.8; eclipse; eclipse public {l} (?:{v})?1(?: 0)?
epl; 0.6; eclipse; eclipse public {l}
epl-2.0; 0.7; epl; epl (?:{v})?2(?: 0)?
epl-1.0; 0.7; epl; epl (?:{v})?1(?: 0)?
eclipse-distribution; 0.7; eclipse; eclipse distribution {l}
eupl-1.2; 0.8; european; european union public {l} (?:{v})?1 2
eupl; 0.7; european; european union public {l}
eupl-1.2; 0.8; eupl; eupl (?:{v})?1 2
eupl; 0.6; eupl; eupl
cddl-1.0; 0.8; common development; common development and distribution {l} (?:{v})?1(?: 0)?
cddl; 0.7; common development; common development and distribution {l}
cddl-1.0; 0.7; cddl; cddl (?:{v})?1(?: 0)?
cddl; 0.6; cddl; cddl(?: 1 1)?
cpl-1.0; 0.7; common public; common public {l}(?: (?:{v})?1(?: 0)?)?
artistic-2.0; 0.8; artistic; artistic {l} (?:{v})?2(?: 0)?
artistic-1.0; 0.7; artistic; artistic {l} (?:{v})?1(?: 0)?
artistic; 0.6; artistic; (?:perl )?artistic {l}
perl; 0.7; perl; same terms as perl(?: itself)?
unlicense; 0.7; unlicense; (?:the )?unlicense
wtfpl; 0.7; wtfpl; wtfpl(?: (?:{v})?2(?: 0)?)?
psf-2.0; 0.8; python, psf; (?:python software foundation|psf) {l}(?: (?:{v})?2(?: 0)?)?
psf-2.0; 0.6; psf; psf {l}(?: agreement)?
ruby; 0.6; ruby; ruby {l}
php-3.01; 0.7; php; php {l}(?: (?:{v})?3(?: 0?1)?)?
openssl; 0.7; openssl; openssl {l}
postgresql; 0.7; postgresql; postgresql {l}
ncsa; 0.7; ncsa, illinois; (?:ncsa|university of illinois(?: ncsa)?)(?: open source)? {l}
vim; 0.6; vim; vim {l}
curl; 0.6; curl; curl {l}
libpng; 0.7; libpng; libpng {l}(?: (?:{v})?2(?: 0)?)?
freetype; 0.7; freetype; freetype(?: project)? {l}
ijg; 0.7; independent jpeg; independent jpeg group(?: {l})?
latex-1.3c; 0.7; latex; latex project public {l}(?: 1 3c?)?
latex-1.3c; 0.6; lppl; lppl(?: 1 3c?)?
ofl-1.1; 0.8; font; (?:sil )?open font {l}(?: (?:{v})?1(?: 1)?)?
ofl-1.1; 0.7; ofl; (?:sil )?ofl(?: (?:{v})?1 1)?
ms-pl; 0.7; microsoft; microsoft public {l}
ms-rl; 0.7; microsoft; microsoft reciprocal {l}
ms-pl; 0.6; ms pl; ms pl
afl-3.0; 0.7; academic; academic free {l}(?: (?:{v})?3(?: 0)?)?
osl-3.0; 0.7; open software; open software {l}(?: (?:{v})?3(?: 0)?)?
ecl-2.0; 0.7; educational; educational community {l}(?: (?:{v})?2(?: 0)?)?
upl-1.0; 0.7; universal permissive; universal permissive {l}(?: (?:{v})?1(?: 0)?)?
blueoak-1.0; 0.7; blue oak; blue oak model {l}(?: 1 0(?: 0)?)?
sspl-1.0; 0.8; server side; server side public {l}(?: (?:{v})?1)?
sspl-1.0; 0.6; sspl; sspl(?: (?:{v})?1)?
bsl-1.1; 0.8; business source; business source {l}(?: (?:{v})?1 1)?
elastic-2.0; 0.7; elastic; elastic {l}(?: (?:{v})?2(?: 0)?)?
commons-clause; 0.7; commons clause; commons clause
polyform; 0.7; polyform; polyform (?:noncommercial|small business|shield|perimeter|strict)(?: {l})?
odbl-1.0; 0.8; database; open (?:data commons )?(?:open )?database {l}(?: (?:{v})?1(?: 0)?)?
odbl-1.0; 0.7; odbl; odbl(?: (?:{v})?1 0)?
odc-by-1.0; 0.7; data commons; open data commons attribution {l}
pddl-1.0; 0.7; public domain dedication; (?:open data commons )?public domain dedication and {l}
ogl-uk-3.0; 0.7; government; open government {l}(?: (?:{v})?[123](?: 0)?)?
cdla; 0.7; community data; community data {l} agreement(?: permissive| sharing)?
openrail; 0.8; openrail, open rail; (?:creativeml |bigcode |bigscience )?open ?rail(?: m| s)?(?: {l})?
openrail; 0.7; responsible ai; responsible ai {l}s?
llama; 0.7; llama; llama(?: [0-9])?(?: [0-9])?(?: community)? {l}(?: agreement)?
gemma; 0.6; gemma; gemma (?:terms of use|{l})
proprietary; 0.7; proprietary; proprietary(?: and confidential| software)? {l}
proprietary; 0.6; proprietary; proprietary and confidential
proprietary; 0.6; unauthorized; unauthorized (?:copying|reproduction|use|distribution) (?:of this (?:file|work|document|material) )?(?:or distribution )?(?:via any medium )?is (?:strictly )?prohibited
proprietary; 0.5; end user; end user {l} agreement
proprietary; 0.5; reproduced; (?:no part of this|may not be) .{0,60}?reproduced .{0,60}?without (?:the )?(?:prior )?(?:written )?permission
non-commercial; 0.5; commercial; (?:for |only for |solely for )?non ?commercial (?:use|purposes)(?: only)?
non-commercial; 0.4; personal; for personal use only
no-derivatives; 0.4; derivative; no derivative works
share-alike; 0.4; alike; share alike(?: {l})?
royalty-free; 0.4; royalty; royalty free {l}
reserved; 0.4; rights reserved; (?:some|no) rights reserved
reserved; 0.4; rights are reserved; all rights are reserved
copyright; 0.4; copyright, ©; (?:copyright|©)(?: (?:c|©))? (?:19|20)[0-9]{2}
copyright; 0.3; copyright; (?:copyright(?:ed)? (?:by|of|holders?|owners?|notice)|all copyrights)
"""


def parse(text: str = RULES) -> list[tuple[str, float, tuple[str, ...], str]]:
    """(label, score, keywords, regex) of each line."""
    found = []
    for line in text.strip().splitlines():
        label, score, keywords, pattern = (x.strip() for x in line.split(";", 3))
        # A version may stand as one word with its v: "v2", "v3".
        pattern = pattern.replace("{l}", "licen[cs]e").replace("{v}", "(?:version |ver |v ?)")
        found.append((label, float(score), tuple(k.strip() for k in keywords.split(",")), pattern))
    return found
