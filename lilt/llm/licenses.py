"""License scans by ordered signature rules.

A rule is a regular expression over a text's words (A-Z in lower case, joined by one space), with a keyword that must occur
before the expression is tried, a priority and a label. Detections are resolved in order of priority, then length, then
place: one whose interval lies inside the interval of a detection already kept is dropped. Phrases of the base contract
stay whatever overlaps them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lilt.llm.common import append_columns, utf8

#: Bytes to words: digits, letters and every byte from 0x80 stay, A-Z in lower case; all else separates.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Families: label, expression of the name, versions, keywords of which one must occur (a space is a word's edge).
FAMILIES = [
    ("apache", r"apache(?: software)?(?: license| licence)?", ("1 0", "1 1", "2 0"), ("apache",)),
    ("gpl", r"(?:gnu )?(?:gpl|general public (?:license|licence))", ("1 0", "2 0", "3 0"), (" gpl ", "general public")),
    ("lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public (?:license|licence))", ("2 0", "2 1", "3 0"), (" lgpl ", "lesser general", "library general")),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public (?:license|licence))", ("1 0", "3 0"), (" agpl ", "affero")),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation (?:license|licence))", ("1 1", "1 2", "1 3"), (" gfdl ", "free documentation")),
    ("mpl", r"(?:mpl|mozilla public (?:license|licence))", ("1 0", "1 1", "2 0"), (" mpl ", "mozilla public")),
    ("epl", r"(?:epl|eclipse public (?:license|licence))", ("1 0", "2 0"), (" epl ", "eclipse public")),
    ("eupl", r"(?:eupl|european union public (?:license|licence))", ("1 0", "1 1", "1 2"), (" eupl ", "european union")),
    ("cddl", r"(?:cddl|common development and distribution (?:license|licence))", ("1 0", "1 1"), (" cddl ", "common development")),
    ("cpl", r"(?:cpl|common public (?:license|licence))", ("1 0",), (" cpl ", "common public")),
    ("osl", r"(?:osl|open software (?:license|licence))", ("1 0", "2 0", "2 1", "3 0"), (" osl ", "open software")),
    ("afl", r"(?:afl|academic free (?:license|licence))", ("1 1", "1 2", "2 0", "2 1", "3 0"), (" afl ", "academic free")),
    ("artistic", r"(?:perl )?artistic (?:license|licence)", ("1 0", "2 0"), ("artistic",)),
    ("zpl", r"(?:zpl|zope public (?:license|licence))", ("1 1", "2 0", "2 1"), (" zpl ", "zope public")),
    ("lppl", r"(?:lppl|latex project public (?:license|licence))", ("1 0", "1 1", "1 2", "1 3c"), (" lppl ", "latex project")),
    ("ofl", r"(?:ofl|sil open font (?:license|licence))", ("1 0", "1 1"), (" ofl ", "open font")),
    ("bsl", r"(?:bsl|boost software (?:license|licence))", ("1 0",), (" bsl ", "boost software")),
    ("busl", r"(?:busl|business source (?:license|licence))", ("1 1",), (" busl ", "business source")),
    ("sspl", r"(?:sspl|server side public (?:license|licence))", ("1",), (" sspl ", "server side")),
    ("elastic", r"elastic (?:license|licence)", ("1 0", "2 0"), ("elastic",)),
    ("ms-pl", r"(?:ms pl|microsoft public (?:license|licence))", ("1 0",), (" ms pl ", "microsoft public")),
    ("ms-rl", r"(?:ms rl|microsoft reciprocal (?:license|licence))", ("1 0",), (" ms rl ", "microsoft reciprocal")),
    ("cc-by", r"(?:cc by|creative commons attribution)", ("1 0", "2 0", "2 5", "3 0", "4 0"), (" cc by ", "creative commons")),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)", ("1 0", "2 0", "2 5", "3 0", "4 0"), (" cc by sa ", "creative commons")),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)", ("1 0", "2 0", "2 5", "3 0", "4 0"), (" cc by nc ", "creative commons")),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)", ("1 0", "2 0", "2 5", "3 0", "4 0"), (" cc by nd ", "creative commons")),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", ("1 0", "2 0", "2 5", "3 0", "4 0"), (" cc by nc sa ", "creative commons")),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)", ("2 0", "2 5", "3 0", "4 0"), (" cc by nc nd ", "creative commons")),
    ("cc0", r"(?:cc0|creative commons zero|cc zero)", ("1 0",), (" cc0 ", "cc zero", "creative commons")),
    ("odbl", r"(?:odbl|open database (?:license|licence))", ("1 0",), (" odbl ", "open database")),
    ("odc-by", r"(?:odc by|open data commons attribution (?:license|licence))", ("1 0",), (" odc by ", "open data commons")),
    ("pddl", r"(?:pddl|public domain dedication and (?:license|licence))", ("1 0",), (" pddl ", "public domain dedication")),
    ("bsd", r"(?:bsd|berkeley software distribution)(?: license| licence)?", ("2 clause", "3 clause", "4 clause", "0 clause"), (" bsd ", "berkeley software")),
    ("mit", r"(?:mit|expat) (?:license|licence)", (), (" mit ", " expat ")),
    ("isc", r"isc (?:license|licence)", (), (" isc ",)),
    ("zlib", r"(?:zlib|zlib libpng) (?:license|licence)", (), ("zlib",)),
    ("unlicense", r"(?:the )?unlicense", (), ("unlicense",)),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public (?:license|licence))", ("1 0", "2 0"), (" wtfpl ", "what the fuck")),
    ("openssl", r"openssl (?:license|licence)", (), ("openssl",)),
    ("php", r"php (?:license|licence)", ("3 0", "3 01"), (" php ",)),
    ("python", r"(?:psf|python software foundation) (?:license|licence)", ("2 0",), (" psf ", "python software")),
    ("ruby", r"ruby (?:license|licence)", (), (" ruby ",)),
    ("postgresql", r"postgresql (?:license|licence)", (), ("postgresql",)),
    ("vim", r"vim (?:license|licence)", (), (" vim ",)),
    ("w3c", r"w3c (?:software )?(?:notice and )?(?:license|licence)", (), (" w3c ",)),
    ("ncsa", r"(?:ncsa|university of illinois open source) (?:license|licence)", (), (" ncsa ", "university of illinois")),
    ("cecill", r"cecill(?: b| c)?(?: license| licence)?", ("1 0", "1 1", "2 0", "2 1"), ("cecill",)),
    ("qpl", r"(?:qpl|q public (?:license|licence))", ("1 0",), (" qpl ", "q public")),
    ("ijg", r"independent jpeg group (?:license|licence)", (), ("independent jpeg",)),
    ("json", r"json (?:license|licence)", (), (" json ",)),
]

#: Sentences of license texts and notices: label, expression, keyword, priority.
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted", 90),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby granted", 90),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 90),
    ("bsd", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used to endorse", "endorse", 90),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors", "as is", 80),
    ("apache", r"unless required by applicable law or agreed to in writing software distributed under the license", "applicable law", 90),
    ("gpl", r"is free software you can redistribute it and or modify it under the terms of the gnu general public license", "free software", 95),
    ("lgpl", r"is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "free software", 96),
    ("agpl", r"is free software you can redistribute it and or modify it under the terms of the gnu affero general public license", "free software", 96),
    ("mpl", r"this source code form is subject to the terms of the mozilla public license", "source code form", 95),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 95),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain", 60),
    ("reserved", r"all rights? reserved", "reserved", 30),
    ("proprietary", r"proprietary and confidential", "proprietary", 70),
    ("proprietary", r"unauthori[sz]ed (?:copying|use|reproduction|distribution) of this (?:file|text|document|software|work)", "authori", 70),
    ("proprietary", r"may not be (?:copied|reproduced|redistributed|published)(?: \S+){0,6} without (?:prior )?(?:written )?permission", "permission", 70),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*", "copyright", 20),
    ("cc", r"creativecommons org licenses", "creativecommons", 50),
]


#: More sentences and names: label, expression, keyword or keywords of which one must occur, priority.
NOTICES = [
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions", "substantial portions", 85),
    ("mit", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "merchantability", 75),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", "copyright holders", 75),
    ("mit", r"(?:mit|x11|expat) style (?:license|licence)", " style ", 50),
    ("mit", r"dual licensed under (?:the )?mit (?:and|or) (?:the )?(?:gpl|apache)", "dual licensed", 65),
    ("mit-0", r"mit no attribution|mit 0 (?:license|licence)", ("mit no attribution", "mit 0"), 65),
    ("x11", r"(?:mit x11|x11|x consortium) (?:license|licence)", (" x11 ", "x consortium"), 62),
    ("x11", r"except as contained in this notice the name of (?:\S+ ){1,8}shall not be used in advertising", "advertising", 80),
    ("isc", r"the software is provided as is and the author disclaims all warranties with regard to this software", "disclaims all", 80),
    ("isc", r"permission to use copy modify and distribute this software for any purpose", "permission to use", 70),
    ("0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)", "bsd", 66),
    ("bsd", r"redistributions of source code must retain the above copyright notice", "redistributions", 80),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice", "redistributions", 80),
    ("bsd", r"this software is provided by the (?:copyright holders|regents|authors?)(?: \S+){0,3} as is and any express or implied warranties", "as is", 78),
    ("bsd", r"all advertising materials mentioning features or use of this software must display", "advertising materials", 85),
    ("bsd", r"(?:new|modified|revised|simplified|original) bsd(?: license| licence)?", " bsd ", 62),
    ("bsd", r"bsd style (?:license|licence)", " bsd ", 55),
    ("bsd", r"berkeley software distribution", "berkeley", 35),
    ("bsd", r"the regents of the university of california", "regents", 45),
    ("apache", r"you may not use this file except in compliance with the license", "compliance with", 85),
    ("apache", r"you may obtain a copy of the license at http www apache org licenses", "apache org", 90),
    ("apache", r"licensed to the apache software foundation asf under one or more contributor license agreements", "contributor license", 92),
    ("apache", r"asl ?2(?: 0)?", " asl", 45),
    ("apache", r"grant of patent license subject to the terms and conditions of this license", "grant of patent", 75),
    ("gpl", r"either version \d of the license or at your option any later version", "at your option", 60),
    ("gpl", r"you should have received a copy of the gnu general public license along with this program", "you should have received", 94),
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty", "hope that it will be useful", 70),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document", "verbatim copies", 80),
    ("gpl", r"www gnu org licenses gpl(?: html| txt)?", "gnu org", 72),
    ("gpl", r"gplv?[123](?: ?plus| or later| only)?", "gpl", 58),
    ("gpl", r"gnu public (?:license|licence)", "gnu public", 45),
    ("gpl", r"gpl compatible", "gpl compatible", 25),
    ("gpl", r"free software foundation(?: inc)?", "free software foundation", 28),
    ("gpl", r"(?:classpath|linking) exception", " exception ", 48),
    ("gpl", r"as a special exception (?:the copyright holders|you may)", "special exception", 52),
    ("gpl", r"copyleft (?:license|licence)", "copyleft", 26),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license", "you should have received", 95),
    ("lgpl", r"www gnu org licenses lgpl(?: html| txt)?", "gnu org", 73),
    ("lgpl", r"lgplv?[23](?: ?1)?(?: ?plus| or later| only)?", "lgpl", 59),
    ("agpl", r"you should have received a copy of the gnu affero general public license", "affero", 95),
    ("agpl", r"www gnu org licenses agpl(?: html| txt)?", "gnu org", 73),
    ("agpl", r"agplv?3(?: ?plus| or later| only)?", "agpl", 59),
    ("agpl", r"remote network interaction use with the gnu general public license", "remote network", 80),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "free documentation", 95),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts", "invariant sections", 85),
    ("mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at", "the mpl was", 94),
    ("mpl", r"the contents of this file are subject to the mozilla public license", "mozilla public", 94),
    ("mpl", r"mozilla org mpl(?: \d 0)?", "mozilla org", 72),
    ("mpl", r"incompatible with secondary licenses", "secondary licenses", 70),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "accompanying materials", 94),
    ("epl", r"www eclipse org (?:legal|org documents) epl", "eclipse org", 72),
    ("edl", r"eclipse distribution (?:license|licence)", "eclipse distribution", 64),
    ("cpl", r"accompanying program is provided under the terms of this common public license", "common public", 90),
    ("ipl", r"ibm public (?:license|licence)", "ibm public", 64),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", "common development", 94),
    ("eupl", r"licensed under the eupl", " eupl ", 66),
    ("osl", r"licensed under the open software license", "open software", 66),
    ("rpl", r"reciprocal public (?:license|licence)", "reciprocal public", 64),
    ("apsl", r"apple public source (?:license|licence)", "apple public", 64),
    ("spl", r"sun public (?:license|licence)", "sun public", 64),
    ("npl", r"netscape public (?:license|licence)", "netscape public", 64),
    ("nasa", r"nasa open source agreement", "nasa open", 64),
    ("watcom", r"sybase open watcom public (?:license|licence)", "watcom", 64),
    ("upl", r"universal permissive (?:license|licence)", "universal permissive", 64),
    ("mulan", r"mulan (?:psl|permissive software license)(?: v\d)?", "mulan", 64),
    ("ecl", r"educational community (?:license|licence)", "educational community", 64),
    ("blueoak", r"blue oak model (?:license|licence)", "blue oak", 64),
    ("hpnd", r"historical permission notice and disclaimer", "historical permission", 64),
    ("beerware", r"the beer ?ware (?:license|licence)", "beer", 66),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer", "buy me a beer", 90),
    ("bola", r"buena onda license agreement", "buena onda", 64),
    ("jam", r"permission is granted to use this software provided that this copyright notice appears", "permission is granted", 68),
    ("libpng", r"(?:libpng|png reference library) (?:license|licence)", "png", 64),
    ("libtiff", r"libtiff (?:license|licence)", "libtiff", 64),
    ("freetype", r"(?:freetype|ftl) (?:project )?(?:license|licence)", ("freetype", " ftl "), 64),
    ("imagemagick", r"imagemagick (?:license|licence)", "imagemagick", 64),
    ("curl", r"curl (?:license|licence)", "curl", 64),
    ("bzip2", r"bzip2 (?:license|licence)", "bzip2", 64),
    ("icu", r"(?:icu|unicode) (?:license|licence)(?: agreement)?", (" icu ", "unicode li"), 57),
    ("unicode", r"unicode inc (?:license|licence) agreement data files and software", "unicode inc", 80),
    ("intel", r"intel (?:open source|simplified software) (?:license|licence)", "intel", 64),
    ("nvidia", r"nvidia (?:software|source code) (?:license|licence)(?: agreement)?", "nvidia", 64),
    ("oracle", r"oracle (?:technology network|binary code|free use terms) (?:license|licence|and conditions)", "oracle", 64),
    ("adobe", r"adobe (?:systems )?(?:source code|glyph list)? ?(?:license|licence) agreement", "adobe", 60),
    ("openldap", r"(?:the )?openldap public (?:license|licence)", "openldap", 64),
    ("sleepycat", r"sleepycat (?:license|licence)", "sleepycat", 64),
    ("tcl", r"tcl tk (?:license|licence)", "tcl", 64),
    ("ntp", r"ntp (?:license|licence)", " ntp ", 64),
    ("naist", r"naist (?:license|licence)", "naist", 64),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", "intent of this document", 90),
    ("artistic", r"under the same terms as perl(?: itself)?", "as perl", 68),
    ("gpl", r"under the same terms as perl(?: itself)?", "as perl", 67),
    ("ofl", r"this font software is licensed under the sil open font license", "font software", 94),
    ("ofl", r"with reserved font names?", "reserved font", 76),
    ("bitstream", r"bitstream vera fonts? (?:copyright|license)", "bitstream vera", 64),
    ("ubuntu-font", r"ubuntu font (?:license|licence)", "ubuntu font", 66),
    ("bsl", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "accompanying documentation", 93),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free", 90),
    ("unlicense", r"unlicense org", "unlicense org", 60),
    ("zlib", r"altered source versions must be plainly marked as such", "plainly marked", 85),
    ("zlib", r"the origin of this software must not be misrepresented", "misrepresented", 85),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document", "modified copies", 90),
    ("python", r"python software foundation license version \d", "python software", 75),
    ("ruby", r"you may make and give away verbatim copies of the source form of the software without restriction", "give away verbatim", 88),
    ("php", r"this product includes php software freely available from", "php software", 85),
    ("openssl", r"this product includes software developed by the openssl project", "openssl project", 85),
    ("w3c", r"w3c (?:document|software) (?:notice|license|licence)", " w3c ", 64),
    ("ogc", r"ogc (?:software )?(?:notice|license|licence)", " ogc ", 60),
    ("cecill", r"governed by the cecill(?: [abc])? license under french law", "cecill", 90),
    ("etalab", r"(?:licence ouverte|open licence) etalab", "etalab", 66),
    ("ogl", r"open government licence(?: v\d(?: 0)?)?", "open government", 66),
    ("ogl", r"contains public sector information licensed under", "public sector information", 80),
    ("dl-de", r"datenlizenz deutschland(?: namensnennung| zero)?", "datenlizenz", 66),
    ("odbl", r"opendatacommons org licenses odbl", "opendatacommons", 76),
    ("odc-by", r"opendatacommons org licenses by", "opendatacommons", 76),
    ("pddl", r"opendatacommons org licenses pddl", "opendatacommons", 76),
    ("cdla", r"community data (?:license|licence) agreement(?: (?:permissive|sharing))?", "community data", 66),
    ("c-uda", r"computational use of data agreement", "computational use", 66),
    ("cc-by", r"creativecommons org licenses by \d \d", "creativecommons", 82),
    ("cc-by-sa", r"creativecommons org licenses by sa \d \d", "creativecommons", 83),
    ("cc-by-nc", r"creativecommons org licenses by nc \d \d", "creativecommons", 83),
    ("cc-by-nd", r"creativecommons org licenses by nd \d \d", "creativecommons", 83),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa \d \d", "creativecommons", 84),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd \d \d", "creativecommons", 84),
    ("cc0", r"creativecommons org publicdomain zero \d \d", "creativecommons", 84),
    ("public-domain", r"creativecommons org publicdomain mark", "creativecommons", 84),
    ("cc0", r"to the extent possible under law (?:\S+ ){1,12}waived all copyright and related or neighboring rights", "neighboring rights", 90),
    ("cc0", r"no rights reserved", "no rights", 60),
    ("cc", r"some rights reserved", "some rights", 55),
    ("cc", r"this work is licensed under a creative commons", "creative commons", 66),
    ("cc", r"creative commons (?:license|licence)", "creative commons", 46),
    ("cc", r"(?:lizenziert unter|unter der lizenz|publié sous licence|sous licence|bajo licencia|bajo una licencia) (?:der )?(?:creative commons|cc)", ("lizenz", "sous licence", "bajo"), 66),
    ("cc", r"attribution (?:required|4 0 international|3 0 unported)", "attribution", 54),
    ("public-domain", r"(?:is|are) (?:now )?(?:in|part of) the public domain", "public domain", 56),
    ("public-domain", r"no copyright is claimed|not subject to copyright(?: protection)?", "copyright", 58),
    ("public-domain", r"a work of the united states government", "united states government", 58),
    ("public-domain", r"(?:gemeinfrei|domaine public|dominio público)", ("gemeinfrei", "domaine public", "dominio p"), 40),
    ("sspl", r"making the functionality of the program available to third parties as a service", "as a service", 80),
    ("busl", r"change date (?:\S+ ){0,8}change license", "change date", 80),
    ("busl", r"additional use grant", "additional use grant", 60),
    ("commons-clause", r"commons clause(?: license condition)?", "commons clause", 70),
    ("polyform", r"polyform (?:noncommercial|small business|shield|strict|internal use|free trial|perimeter)(?: license)?", "polyform", 70),
    ("prosperity", r"prosperity public (?:license|licence)", "prosperity", 66),
    ("parity", r"parity public (?:license|licence)", "parity", 66),
    ("hippocratic", r"hippocratic (?:license|licence)", "hippocratic", 66),
    ("rail", r"open ?rail ?[mds]? (?:license|licence)s?", "rail", 64),
    ("rail", r"responsible ai (?:license|licence)s?", "responsible ai", 65),
    ("llama", r"llama \d(?: \d)? community (?:license|licence)(?: agreement)?", "llama", 70),
    ("gemma", r"gemma terms of use", "gemma", 66),
    ("research", r"for (?:non commercial|noncommercial) research (?:purposes|use)(?: only)?", "research", 60),
    ("research", r"for (?:academic|research|educational)(?: and (?:academic|research|educational))? (?:purposes|use) only", ("purposes only", "use only"), 60),
    ("non-commercial", r"(?:for )?(?:non commercial|noncommercial|personal) use only", "use only", 58),
    ("non-commercial", r"not for commercial (?:use|distribution|resale)", "not for commercial", 58),
    ("non-commercial", r"commercial use (?:is )?(?:prohibited|forbidden|not (?:allowed|permitted))", "commercial use", 58),
    ("proprietary", r"may not be (?:used|sold|disclosed|transmitted)(?: \S+){0,6} without (?:prior |the )?(?:express )?(?:written )?(?:permission|consent)", "may not be", 68),
    ("proprietary", r"trade secrets? (?:and|or) (?:confidential|proprietary)", "trade secret", 66),
    ("proprietary", r"this (?:software|document|file) is (?:the )?(?:confidential|proprietary)", ("is confidential", "is proprietary", "is the confidential", "is the proprietary"), 66),
    ("proprietary", r"(?:confidential|proprietary) (?:and|or) (?:proprietary|confidential) information", ("confidential and", "confidential or", "proprietary and", "proprietary or"), 64),
    ("proprietary", r"strictly (?:confidential|prohibited)", "strictly", 50),
    ("proprietary", r"subject to (?:the terms of )?(?:a|an|the|your) (?:end user )?(?:license|licence) agreement", "subject to", 56),
    ("proprietary", r"end user (?:license|licence) agreement|eula", ("end user", " eula "), 46),
    ("proprietary", r"not for (?:redistribution|distribution|publication|release)", "not for", 52),
    ("proprietary", r"internal use only|do not distribute|company confidential", ("internal use only", "do not distribute", "company confidential"), 52),
    ("reserved", r"(?:alle rechte vorbehalten|tous droits réservés|todos los derechos reservados|tutti i diritti riservati|todos os direitos reservados)", ("vorbehalten", "tous droits", "derechos reservados", "diritti riservati", "direitos reservados"), 32),
    ("reserved", r"(?:rights|permissions) (?:are )?reserved (?:by|to)", "reserved", 24),
    ("copyright", r"copyright (?:c )?by (?:the )?(?:authors?|contributors?|owners?)", "copyright", 22),
    ("copyright", r"(?:the )?copyright (?:holders?|owners?|notice)", "copyright", 18),
    ("copyright", r"© ?(?:19|20)\d\d", "©", 21),
    ("trademark", r"(?:is|are) (?:a )?(?:registered )?trademarks? of", "trademark", 16),
    ("patent", r"(?:patents?|patent applications?) pending", "pending", 16),
    ("license", r"see (?:the )?(?:license|licence|copying)(?: (?:txt|md))? (?:file )?for (?:details|more information|license terms|the full license)", ("see the", "see licen", "see copying"), 22),
    ("license", r"licensed under the terms (?:of|described in|found in) (?:the )?(?:license|licence)", "licensed under", 22),
    ("license", r"(?:license|licence) terms and conditions", "terms and conditions", 18),
    ("license", r"spdx license identifier \S+", " spdx ", 30),
    ("license", r"dual licensed|multi licensed|dual license", ("dual licens", "multi licens"), 24),
]


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    priority: int
    weight: float


@dataclass(frozen=True)
class Detection:
    label: str
    start: int
    stop: int
    priority: int
    weight: float


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules: for every family its tag, its name, and for every version the name and the tag with it; then sentences and notices."""
    out = []

    def add(label: str, keywords: tuple[str, ...], expression: str, priority: int, weight: float) -> None:
        pattern = re.compile(rb"(?<![^ ])(?:" + expression.encode() + rb")(?![^ ])")
        out.append(Rule(label, tuple(k.encode() for k in keywords), pattern, priority, weight))

    for label, name, versions, keywords in FAMILIES:
        tag = label.replace("-", " ")
        add(label, (" spdx ",), rf"spdx license identifier {tag}(?: only| or later)?", 100, 1.0)
        add(label, keywords, rf"(?:the )?{name}", 40, 0.7)
        add(label, keywords, rf"(?:distributed|released|available|published|licen[sc]ed) under (?:the |a )?(?:terms of the )?{name}", 60, 0.9)
        for version in versions:
            number = version.replace(" 0", "(?: 0)?") if version.endswith(" 0") else version
            numbered = f"{label}-{version.replace(' ', '-' if 'clause' in version else '.')}"
            add(numbered, keywords, rf"{name} (?:version |v )?v?{number}", 70, 0.9)
            add(numbered, (" spdx ",), rf"spdx license identifier {tag} {version}(?: only| or later)?", 110, 1.0)
    for label, expression, gate, priority in [*SENTENCES, *NOTICES]:
        add(label, (gate,) if isinstance(gate, str) else gate, expression, priority, priority / 100)
    return tuple(sorted(out, key=lambda r: (-r.priority, r.label, r.pattern.pattern)))


def detect(words: bytes) -> list[Detection]:
    """Resolved detections in a normal text (words joined by one space), as word intervals, in order of place."""
    padded, found = b" " + words + b" ", []
    present = {k: k in padded for k in keywords()}
    for rule in rules():
        if any(present[k] for k in rule.keywords):
            start = at = 0
            for m in rule.pattern.finditer(words):
                start, at = start + words.count(b" ", at, m.start()), m.start()
                found.append(Detection(rule.label, start, start + m.group().count(b" ") + 1, rule.priority, rule.weight))
    return resolve(found)


@lru_cache(maxsize=1)
def keywords() -> tuple[bytes, ...]:
    """The distinct keywords of all rules."""
    return tuple(dict.fromkeys(k for rule in rules() for k in rule.keywords))


def resolve(found: list[Detection]) -> list[Detection]:
    """Drops each detection whose interval is inside one kept before it, by priority, length, place and label.

    A prefix-maximum tree over starts gives the furthest end of the kept intervals that start at or before a place.
    """
    place = {start: i + 1 for i, start in enumerate(sorted({d.start for d in found}))}
    furthest, kept = [-1] * (len(place) + 1), []
    for d in sorted(set(found), key=lambda d: (-d.priority, d.start - d.stop, d.start, d.label)):
        i, end = place[d.start], -1
        while i:
            end = max(end, furthest[i])
            i &= i - 1
        if end >= d.stop:
            continue
        kept.append(d)
        i = place[d.start]
        while i < len(furthest):
            furthest[i] = max(furthest[i], d.stop)
            i += i & -i
    return sorted(kept, key=lambda d: (d.start, d.stop, d.label))


def phrase_places(words: bytes, phrase: bytes) -> list[int]:
    """Word positions at which a phrase's words stand consecutively, overlapping places included."""
    padded, look, out, at, count, last = b" " + words + b" ", b" " + phrase + b" ", [], 0, 0, 0
    while (at := padded.find(look, at)) >= 0:
        count += padded.count(b" ", last, at)
        last = at
        out.append(count)
        at += 1
    return out


@dataclass(frozen=True)
class Scan:
    n_words: int
    places: list[int]
    base_labels: list[str]
    labels: list[str]
    score: float
    detections: list[Detection]


def scan(text: bytes | None) -> Scan:
    """Base phrases and rule detections of one whole text; null counts as empty."""
    parts = (text or b"").translate(NORMAL).split()
    words = b" ".join(parts)
    places: list[int] = []
    base = set()
    for phrase, label in PHRASES.items():
        if phrase.encode() in words and (at := phrase_places(words, phrase.encode())):
            places += at
            base.add(label)
    found = detect(words)
    doubt = 1.0
    for label in {d.label for d in found}:
        doubt *= 1 - max(d.weight for d in found if d.label == label)
    return Scan(len(parts), sorted(places), sorted(base), sorted(base | {d.label for d in found}), max(1 - doubt, 0.3 if base else 0.0), found)


def scan_licenses(docs: DataFrame, text_col: str = "text", only: list[str] | None = None) -> DataFrame:
    """docs with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``, ``detections``.

    Whole texts count, whatever their length; an empty table gives no rows. Words are runs of 0-9, A-Z, a-z and non-ASCII characters. n_base counts the places of all base phrases, first_word and
    last_word are their smallest and largest start (null without any); labels are sorted, distinct and joined by commas,
    base ones always among them; score is 1 minus the product of the labels' doubts, 0.3 at least with a base phrase;
    detections are the resolved intervals of words. Null and empty texts have no words, no labels and score 0. Rows are
    independent; input columns named like the new ones are replaced.
    """

    def make():
        rules()

        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            s = [scan(t) for t in utf8(batch.column(text_col))]
            spans = [[{"label": d.label, "start": d.start, "stop": d.stop} for d in x.detections] for x in s]
            return [
                pa.array([x.n_words for x in s], pa.int64()),
                pa.array([len(x.places) for x in s], pa.int64()),
                pa.array([x.places[0] if x.places else None for x in s], pa.int64()),
                pa.array([x.places[-1] if x.places else None for x in s], pa.int64()),
                pa.array([",".join(x.base_labels) for x in s]),
                pa.array([",".join(x.labels) for x in s]),
                pa.array([x.score for x in s], pa.float64()),
                pa.array(spans, pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))),
            ]

        return kernel

    longs = [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    span = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    fields = longs + [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("detections", T.ArrayType(span))]
    return append_columns(docs, make, fields, only)
