"""License scan with ordered signature rules (operator 4).

Rules are regular expressions over a text's words (joined by single spaces). Each has a priority, a
confidence and gates: one Aho-Corasick pass finds the keywords of all rules, and only rules with a keyword
of every gate in the text are run. Overlapping detections are resolved in order of priority, then length:
one lying inside an interval already kept is suppressed. The rules are hand-written signatures of license
texts, notices, headers and addresses (``SIGNATURES``), and every license name of ``NAMES`` in every phrase of
``PHRASES``.

Base phrases are counted at all their places, whether or not a rule covers them.

One narrow pass over the texts, nothing is shuffled; memory is bounded by one batch of texts.
Defined cases: null text counts as empty: no words, no labels, score 0, null positions; ids are carried
as they come, repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values

#: Every byte that is not part of a word becomes a space; A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_CONFIDENCE = 0.5

# label, keywords (any of them; each alternative of the name contains one), name as a pattern over words
NAMES = [
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)?(?: public)?"),
    ("mit", "mit", r"mit(?: x11| expat)?"),
    ("bsd-2-clause", "bsd|freebsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)"),
    ("bsd", "bsd|berkeley", r"(?:berkeley software distribution|bsd)"),
    ("gpl-1.0", "g", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?v?1(?: 0)?"),
    ("gpl-2.0", "g", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?v?2(?: 0)?"),
    ("gpl-3.0", "g", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?v?3(?: 0)?"),
    ("lgpl-2.1", "l", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public license)(?: version| v)? ?v?2(?: 1)?"),
    ("lgpl-3.0", "l", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?v?3(?: 0)?"),
    ("agpl-3.0", "a", r"(?:gnu )?(?:agpl|affero general public license)(?: version| v)? ?v?3(?: 0)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation license"),
    ("mpl-1.1", "m", r"(?:mpl|mozilla public license)(?: version| v)? ?1 1"),
    ("mpl-2.0", "m", r"(?:mpl|mozilla public license)(?: version| v)? ?2(?: 0)?"),
    ("epl-1.0", "e", r"(?:epl|eclipse public license)(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "e", r"(?:epl|eclipse public license)(?: version| v)? ?2(?: 0)?"),
    ("eupl", "e", r"(?:eupl|european union public licen[cs]e)"),
    ("cddl", "c", r"(?:cddl|common development and distribution license)"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("bsl-1.0", "boost", r"boost(?: software license)?(?: version)?(?: 1 0)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("cc0-1.0", "c", r"(?:cc0|creative commons zero)(?: 1 0)?"),
    ("cc-by-3.0", "c", r"(?:cc by|creative commons attribution) 3 0"),
    ("cc-by-4.0", "c", r"(?:cc by|creative commons attribution) 4 0"),
    ("cc-by-sa", "sa", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-sa", "share", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc", "nc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc", "non", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "nc sa", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "nc nd", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nd", "nd", r"cc by nd(?: [1-4] [05])?"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic-2.0", "artistic", r"artistic(?: license)?(?: 2 0)?"),
    ("psf-2.0", "python", r"python(?: software foundation)?"),
    ("ofl-1.1", "o", r"(?:ofl|sil open font license)(?: version)?(?: 1 1)?"),
    ("ms-pl", "microsoft", r"microsoft public"),
    ("postgresql", "postgresql", r"postgresql"),
    ("odbl", "o", r"(?:odbl|open database license)"),
    ("openssl", "openssl", r"openssl"),
]
# priority (lower first), confidence, keyword, pattern around the name
PHRASES = [
    (1, 0.99, "spdx license identifier", r"spdx license identifier {name}(?: or later| only)?"),
    (2, 0.95, " under ", r"(?:released|licensed|distributed|available|published|provided|made available) under (?:the )?(?:terms of (?:the )?)?{name}(?: public)?(?: licen[cs]e)?"),
    (3, 0.9, " terms ", r"(?:subject to|accept|agree to|according to) the terms (?:and conditions )?of (?:the )?{name}(?: licen[cs]e)?"),
    (4, 0.85, " licen", r"{name} licen[cs]ed?"),
    (4, 0.85, " licen", r"licen[cs]e (?:is |type |name )?{name}"),
    (5, 0.8, " see ", r"see (?:the )?{name}(?: licen[cs]e)? for (?:more )?details"),
]

#: Hand-written signatures of license texts, notices, headers, addresses and file tags: label, priority, confidence,
#: gate (any of the phrases), pattern over words.
SIGNATURES = [
    # grants and conditions of the texts themselves
    ("mit", 1, 0.97, " permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)?(?: to deal in the software without restriction)?"),
    ("mit", 2, 0.9, " copies or substantial portions", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit-0", 2, 0.8, " deal in the software without restriction", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("x11", 1, 0.95, " x consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("bsd", 1, 0.93, " redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?"),
    ("bsd-2-clause", 2, 0.85, " must reproduce the above copyright notice", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by"),
    ("bsd-3-clause", 1, 0.95, " endorse or promote products", r"neither the names? of (?:the )?(?:copyright holders?|author|authors|university|organization|company)(?: nor the names of (?:its|their|any) contributors)? may be used to endorse or promote products derived from this software(?: without specific prior written permission)?"),
    ("bsd-3-clause", 2, 0.9, " endorse or promote products", r"may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", 1, 0.95, " all advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("0bsd", 1, 0.93, " permission to use copy modify and or distribute", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("isc", 2, 0.93, " permission to use copy modify and", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?: provided that the above copyright notice and this permission notice appear in all copies)?"),
    ("ntp", 2, 0.9, " this software and its documentation for any purpose", r"permission to use copy modify and distribute this software and its documentation for any purpose(?: with or)? without fee is hereby granted"),
    ("postgresql", 1, 0.93, " without a written agreement is hereby granted", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("zlib", 1, 0.95, " misrepresented", r"the origin of this software must not be misrepresented(?: you must not claim that you wrote the original software)?"),
    ("zlib", 2, 0.9, " altered source versions", r"altered source versions must be plainly marked as such(?: and must not be misrepresented as being the original software)?"),
    ("bsl-1.0", 1, 0.96, " obtaining a copy of the software and accompanying documentation", r"to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", 1, 0.97, " free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 2, 0.85, " anyone is free to copy", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 1, 0.97, " what the fuck you want to", r"you just do what the fuck you want to"),
    ("wtfpl", 2, 0.95, " what the fuck you want to", r"do what the fuck you want to public license"),
    ("beerware", 1, 0.95, " beer", r"you can buy me a beer in return"),
    ("beerware", 2, 0.9, " beer", r"the beer ?ware license"),
    ("json", 1, 0.95, " for good not evil", r"the software shall be used for good not evil"),
    ("curl", 2, 0.8, " copyright and permission notice", r"copyright and permission notice copyright c"),
    ("openssl", 1, 0.95, " openssl toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("apache-1.1", 2, 0.9, " apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("php-3.01", 1, 0.93, " php", r"this product includes php software freely available from"),
    ("python-2.0", 1, 0.93, " python software foundation", r"this license agreement is between the python software foundation(?: psf)? and the individual or organization"),
    ("artistic-1.0", 2, 0.85, " the intent of this document", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", 2, 0.85, " establishes the terms", r"this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("ofl-1.1", 1, 0.95, " open font license", r"this font software is licensed under the sil open font license(?: version 1 1)?"),
    ("ofl-1.1", 2, 0.9, " stimulate worldwide development", r"the goals of the open font license ofl are to stimulate worldwide development"),
    ("ms-pl", 2, 0.85, " if you use the software you accept", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("upl-1.0", 1, 0.94, " larger works| lrgrwrks", r"any piece of software and or hardware listed in the lrgrwrks txt file|the larger works to which the software is contributed by such licensors"),
    ("vim", 1, 0.93, " uganda", r"vim is charityware you can use and copy it as much as you like but you are encouraged to make a donation for needy children in uganda"),
    ("cc0-1.0", 1, 0.95, " affirmer| associated cc0", r"the person who associated cc0 with this work has dedicated the work to the public domain|affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    # copyleft texts and notices
    ("gpl-1.0-or-later", 1, 0.95, " either version 1", r"gnu general public license as published by the free software foundation either version 1(?: of the license)? or(?: at your option)? any later version"),
    ("gpl-2.0-or-later", 1, 0.97, " either version 2", r"gnu general public license as published by the free software foundation either version 2(?: of the license)? or(?: at your option)? any later version"),
    ("gpl-3.0-or-later", 1, 0.97, " either version 3", r"gnu general public license as published by the free software foundation either version 3(?: of the license)? or(?: at your option)? any later version"),
    ("gpl-2.0-only", 1, 0.93, " free software foundation", r"gnu general public license version 2(?: only)? as published by the free software foundation"),
    ("gpl-3.0-only", 1, 0.93, " free software foundation", r"gnu general public license version 3(?: only)? as published by the free software foundation"),
    ("gpl", 3, 0.85, " redistribute it and or modify it under the terms of the gnu general", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-1.0", 2, 0.9, " version 1 february 1989", r"gnu general public license version 1 february 1989"),
    ("gpl-2.0", 2, 0.95, " version 2 june 1991", r"gnu general public license version 2 june 1991"),
    ("gpl-3.0", 2, 0.95, " version 3 29 june 2007", r"gnu general public license version 3 29 june 2007"),
    ("gpl-2.0", 3, 0.85, " licenses for most software", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", 3, 0.85, " copyleft license for software", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-classpath", 1, 0.95, " linking this library statically", r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-gcc-exception", 2, 0.9, " gcc runtime library exception", r"gcc runtime library exception"),
    ("lgpl-2.0-or-later", 1, 0.95, " library general public license", r"gnu library general public license as published by the free software foundation either version 2(?: of the license)? or(?: at your option)? any later version"),
    ("lgpl-2.1-or-later", 1, 0.97, " lesser general public license", r"gnu lesser general public license as published by the free software foundation either version 2 1(?: of the license)? or(?: at your option)? any later version"),
    ("lgpl-3.0-or-later", 1, 0.97, " lesser general public license", r"gnu lesser general public license as published by the free software foundation either version 3(?: of the license)? or(?: at your option)? any later version"),
    ("lgpl-2.1", 2, 0.95, " version 2 1 february 1999", r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3.0", 2, 0.95, " version 3 29 june 2007", r"gnu lesser general public license version 3 29 june 2007"),
    ("lgpl", 3, 0.85, " lesser general public license", r"(?:under the terms of|license is) the gnu lesser general public license"),
    ("agpl-3.0-or-later", 1, 0.97, " affero general public license", r"gnu affero general public license as published by the free software foundation either version 3(?: of the license)? or(?: at your option)? any later version"),
    ("agpl-3.0", 2, 0.95, " version 3 19 november 2007", r"gnu affero general public license version 3 19 november 2007"),
    ("agpl", 3, 0.85, " affero general public license", r"(?:gnu )?affero general public license"),
    ("gfdl-1.2", 1, 0.95, " free documentation license version 1 2", r"gnu free documentation license version 1 2(?: or any later version)?"),
    ("gfdl-1.3", 1, 0.95, " free documentation license version 1 3", r"gnu free documentation license version 1 3(?: or any later version)?"),
    ("gfdl", 3, 0.8, " no invariant sections", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2.0", 1, 0.97, " mozilla public license", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0"),
    ("mpl-2.0", 2, 0.9, " mozilla public license", r"mozilla public license v(?:ersion)? 2 0"),
    ("mpl-1.1", 1, 0.95, " mozilla public license", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.0", 2, 0.9, " mozilla public license", r"mozilla public license v(?:ersion)? 1 0"),
    ("npl-1.1", 1, 0.93, " netscape public license", r"netscape public license(?: version 1 [01])?"),
    ("epl-1.0", 1, 0.96, " eclipse public license", r"made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", 1, 0.96, " eclipse public license", r"made available under the terms of the eclipse public license(?: v)? 2 0"),
    ("cpl-1.0", 1, 0.93, " common public license", r"common public license v(?:ersion)? ?1 0"),
    ("ipl-1.0", 2, 0.9, " ibm public license", r"ibm public license v(?:ersion)? ?1 0"),
    ("cddl-1.0", 1, 0.95, " common development and distribution license", r"subject to the terms of the common development and distribution license"),
    ("eupl-1.2", 1, 0.95, " eupl", r"licensed under the eupl(?: version| v)? ?1 2"),
    ("cecill-2.1", 1, 0.93, " cecill", r"governed by the cecill(?: b| c)? license under french law"),
    ("osl-3.0", 1, 0.93, " open software license", r"licensed under the open software license version 3 0"),
    ("afl-3.0", 1, 0.93, " academic free license", r"licensed under the academic free license version 3 0"),
    ("sspl-1.0", 1, 0.95, " server side public license", r"server side public license(?: v(?:ersion)? ?1)?"),
    ("busl-1.1", 1, 0.95, " business source license", r"business source license(?: 1 1)?"),
    ("elastic-2.0", 1, 0.95, " elastic license", r"elastic license 2 0"),
    ("polyform", 1, 0.93, " polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter) license"),
    ("commons-clause", 1, 0.93, " commons clause", r"commons clause license condition"),
    # apache headers
    ("apache-2.0", 1, 0.98, " apache license", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", 2, 0.93, " version 2 0 january 2004", r"apache license version 2 0 january 2004"),
    ("apache-2.0", 2, 0.9, " contributor license agreements", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", 3, 0.75, " software distributed under the license is distributed", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    # Creative Commons and data licenses
    ("cc-by-sa", 1, 0.95, " creative commons", r"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-nc-sa", 1, 0.96, " creative commons", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-nc-nd", 1, 0.96, " creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-nc", 2, 0.95, " creative commons", r"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-nd", 1, 0.95, " creative commons", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-4.0", 2, 0.95, " creative commons", r"creative commons attribution 4 0(?: international)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-3.0", 2, 0.95, " creative commons", r"creative commons attribution 3 0(?: unported)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-2.5", 2, 0.95, " creative commons", r"creative commons attribution 2 5(?: generic)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by", 3, 0.9, " creative commons", r"creative commons attribution(?: public)? licen[cs]e"),
    ("cc", 4, 0.7, " creative commons", r"(?:under a |a )?creative commons licen[cs]e"),
    ("cc0-1.0", 2, 0.95, " universal", r"cc0 1 0 universal(?: public domain dedication)?"),
    ("public-domain-mark", 2, 0.9, " public domain mark", r"public domain mark 1 0"),
    ("odbl", 1, 0.95, " open database license", r"made available under the open database license"),
    ("odc-by", 1, 0.94, " open data commons", r"open data commons attribution license(?: v(?:ersion)? ?1 0)?"),
    ("pddl", 1, 0.94, " open data commons", r"open data commons public domain dedication and license"),
    ("cdla-permissive", 1, 0.94, " community data license agreement", r"community data license agreement permissive(?: version)?(?: [12] 0)?"),
    ("cdla-sharing", 1, 0.94, " community data license agreement", r"community data license agreement sharing(?: version)?(?: 1 0)?"),
    ("ogl-uk-3.0", 1, 0.94, " open government licen", r"open government licen[cs]e v(?:ersion)? ?3 0"),
    ("ogl", 3, 0.85, " open government licen", r"open government licen[cs]e"),
    # addresses
    ("apache-2.0", 2, 0.93, " apache org licenses", r"apache org licenses license 2 0"),
    ("mit", 2, 0.93, " opensource org licenses", r"opensource org licenses mit(?: license)?"),
    ("bsd-2-clause", 2, 0.93, " opensource org licenses", r"opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", 2, 0.93, " opensource org licenses", r"opensource org licenses bsd 3 clause"),
    ("isc", 2, 0.93, " opensource org licenses", r"opensource org licenses isc"),
    ("gpl-2.0", 2, 0.9, " gnu org licenses", r"gnu org licenses(?: old licenses)? gpl 2 0"),
    ("gpl-3.0", 2, 0.9, " gnu org licenses", r"gnu org licenses gpl 3 0"),
    ("lgpl-2.1", 2, 0.9, " gnu org licenses", r"gnu org licenses(?: old licenses)? lgpl 2 1"),
    ("lgpl-3.0", 2, 0.9, " gnu org licenses", r"gnu org licenses lgpl 3 0"),
    ("agpl-3.0", 2, 0.9, " gnu org licenses", r"gnu org licenses agpl 3 0"),
    ("mpl-2.0", 2, 0.93, " mozilla org", r"mozilla org mpl 2 0"),
    ("epl-2.0", 2, 0.93, " eclipse org", r"eclipse org legal epl (?:v20|2 0)"),
    ("epl-1.0", 2, 0.93, " eclipse org", r"eclipse org legal epl v10"),
    ("unlicense", 2, 0.9, " unlicense org", r"unlicense org"),
    ("bsl-1.0", 2, 0.93, " boost org", r"boost org license 1 0 txt"),
    ("cc0-1.0", 2, 0.95, " creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("public-domain-mark", 2, 0.9, " creativecommons org", r"creativecommons org publicdomain mark 1 0"),
    ("cc-by", 3, 0.93, " creativecommons org", r"creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", 2, 0.95, " creativecommons org", r"creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nd", 2, 0.95, " creativecommons org", r"creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", 2, 0.95, " creativecommons org", r"creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", 2, 0.95, " creativecommons org", r"creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", 2, 0.95, " creativecommons org", r"creativecommons org licenses by nc nd [1-4] [05]"),
    # plain words
    ("public-domain", 4, 0.75, " public domain", r"(?:released into|dedicated to|placed in|is in|are in|belongs to) the public domain"),
    ("proprietary", 4, 0.75, " proprietary and confidential", r"proprietary and confidential"),
    ("proprietary", 4, 0.75, " strictly prohibited", r"unauthorized (?:copying|reproduction|distribution|use) (?:of this file |of this document )?(?:via any medium )?is strictly prohibited"),
    ("proprietary", 4, 0.7, " written permission", r"may not be (?:reproduced|copied|redistributed|republished) (?:in any form )?without (?:the )?(?:prior |express )?written permission"),
]


class Rule(NamedTuple):
    priority: int
    label: str
    confidence: float
    gates: frozenset[frozenset[str]]  # of each, one keyword must occur
    pattern: re.Pattern[bytes]


def _rules() -> list[Rule]:
    out = []
    for label, keywords, name in NAMES:
        for priority, confidence, own, around in PHRASES:
            # a keyword of one letter stands for several spellings: the phrase's keyword gates alone
            names = [frozenset(f" {k}" for k in keywords.split("|"))] if len(keywords) > 1 else []
            gates = frozenset([frozenset([own]), *names])
            pattern = re.compile(f"(?<= ){around.format(name=name)}(?= )".encode())
            out.append(Rule(priority, label, confidence, gates, pattern))
    for label, priority, confidence, gate, words in SIGNATURES:
        pattern = re.compile(f"(?<= )(?:{words})(?= )".encode())
        out.append(Rule(priority, label, confidence, frozenset([frozenset(gate.split("|"))]), pattern))
    return out


class Scanner:
    def __init__(self) -> None:
        self.rules = _rules()
        self.keywords = ahocorasick.Automaton()
        self.gates = {gate for r in self.rules for gate in r.gates}
        for k in sorted({k for gate in self.gates for k in gate}):
            self.keywords.add_word(k, k)
        self.keywords.make_automaton()

    def detect(self, joined: bytes) -> list[tuple[int, int, str, float]]:
        """(first byte, end, label, confidence) of the detections that stand, in order of priority."""
        present = {k for _, k in self.keywords.iter(joined.decode("latin-1"))}
        if not present:
            return []
        passed = {gate for gate in self.gates if not gate.isdisjoint(present)}
        found = [
            (r.priority, m.start() - m.end(), m.start(), r.label, r.confidence)
            for r in self.rules
            if r.gates <= passed
            for m in r.pattern.finditer(joined)
        ]
        kept: list[tuple[int, int, str, float]] = []
        starts: list[int] = []  # of the kept intervals that lie in no other; their ends rise with them
        ends: list[int] = []
        for _, minus, start, label, confidence in sorted(found):
            end = start - minus
            at = bisect_right(starts, start)
            if at and ends[at - 1] >= end:
                continue
            kept.append((start, end, label, confidence))
            inner = bisect_right(ends, end)
            at = at - 1 if at and starts[at - 1] == start else at
            starts[at:inner], ends[at:inner] = [start], [end]
        return kept

    def scan(self, text: bytes) -> dict:
        words = text.translate(WORD_BYTES).split()
        joined = b" " + b" ".join(words) + b" "
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)

        def word(at: int) -> int:
            """Number of the word that starts after, or holds, byte ``at``."""
            return int(np.searchsorted(gaps, at))

        places, base = [], set()
        for phrase, label in BASE.items():
            needle = f" {phrase} ".encode()
            at = joined.find(needle)
            while at >= 0:
                places.append(word(at))
                base.add(label)
                at = joined.find(needle, at + 1)
        spans = [
            {"label": label, "first": word(s) - 1, "n_words": word(e) - word(s) + 1, "confidence": c}
            for s, e, label, c in self.detect(joined)
        ]
        doubt, labels = 1.0, set(base)
        for label in sorted(base):
            doubt *= 1 - BASE_CONFIDENCE
        best: dict[str, float] = {}
        for s in spans:
            best[s["label"]] = max(best.get(s["label"], 0.0), s["confidence"])
        for label in sorted(best):
            doubt *= 1 - best[label]
            labels.add(label)
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            "score": 1 - doubt,
            "spans": spans,
        }


_SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("n_words", pa.int64()), ("confidence", pa.float64())])
_ROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.list_(_SPAN)),
    ]
)
_scanner: list[Scanner] = []


def _scan(text: pa.Array) -> pa.Array:
    if not _scanner:
        _scanner.append(Scanner())
    return pa.array([_scanner[0].scan(t) for t in byte_values(text)], _ROW)


def scan(text: Column) -> Column:
    """Struct of n_words, n_base, first_word, last_word, base_labels, labels, score and spans (the
    standing detections: label, first word, words, confidence)."""
    span = T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("confidence", T.DoubleType()),
        ]
    )
    kinds = [T.LongType()] * 4 + [T.StringType()] * 2 + [T.DoubleType(), T.ArrayType(span)]
    return F.arrow_udf(_scan, T.StructType([T.StructField(f.name, k) for f, k in zip(_ROW, kinds)]))(text)
