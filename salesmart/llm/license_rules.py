"""Signature rules of licenses: hand-written patterns over normalised words.

A text is lower-cased and cut into words of letters and digits, which are joined by single
spaces; patterns see that. Names are expanded by the notice forms below into one rule each;
sentences and addresses stand for themselves. A rule is tried only where its keyword, one or
more whole words, occurs, or another of its keywords (parted by ``|``): every text that a
pattern matches holds one of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Label, keyword, pattern of the name. Versions are words of their own.
NAMES = (
    ("0bsd", "bsd|0bsd", r"(?:0bsd|bsd zero clause(?: license)?|zero clause bsd(?: license)?)"),
    ("aal", "attribution assurance", r"attribution assurance license"),
    ("afl-2.1", "academic free", r"academic free license(?: v| version)? ?2 1"),
    ("afl-3", "academic free", r"academic free license(?: v| version)? ?3(?: 0)?"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: v| version)? ?3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("agpl-3", "agpl|agpl3|agplv3", r"(?:gnu )?agpl ?v?3(?: 0)?"),
    ("agpl-3", "agplv3", r"(?:gnu )?agplv3(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[cs]e(?: v| version)? ?1 1"),
    ("apache-2", "apache", r"apache(?: software)? licen[cs]e(?: v| version)? ?2(?: 0)?"),
    ("apache-2", "apache", r"apache 2(?: 0)?(?: licen[cs]e)?"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("apsl-2", "apple public", r"apple public source license(?: v| version)? ?2(?: 0)?"),
    ("artistic-1", "artistic", r"(?:clarified )?artistic licen[cs]e(?: v| version)? ?1(?: 0)?"),
    ("artistic-2", "artistic", r"artistic licen[cs]e(?: v| version)? ?2(?: 0)?"),
    ("artistic", "artistic", r"artistic licen[cs]e"),
    ("beerware", "beerware", r"beerware(?: licen[cs]e)?"),
    ("beerware", "beer ware", r"beer ware licen[cs]e"),
    ("bsd-2-clause", "bsd|freebsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?:(?: v| version)? ?1(?: 0)?)?"),
    ("busl-1.1", "business source", r"business source licen[cs]e(?:(?: v| version)? ?1 1)?"),
    ("cc0-1.0", "cc0|cc01", r"(?:creative commons )?cc0(?:(?: v| version)? ?1(?: 0)?)?(?: universal)?"),
    ("cc-by", "creative commons", r"creative commons attribution(?: licen[cs]e)?"),
    ("cc-by-1.0", "creative commons", r"creative commons attribution 1 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-2.0", "creative commons", r"creative commons attribution 2 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-3.0", "creative commons", r"creative commons attribution 3 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-4.0", "creative commons", r"creative commons attribution 4 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-sa-2.0", "creative commons", r"creative commons attribution share ?alike 2 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-sa-2.5", "creative commons", r"creative commons attribution share ?alike 2 5(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-sa-3.0", "creative commons", r"creative commons attribution share ?alike 3 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-sa-4.0", "creative commons", r"creative commons attribution share ?alike 4 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-nc-3.0", "creative commons", r"creative commons attribution non ?commercial 3 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-nc-4.0", "creative commons", r"creative commons attribution non ?commercial 4 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-nc-sa-4.0", "creative commons", r"creative commons attribution non ?commercial share ?alike 4 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-nc-nd-4.0", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:s|atives|ativeworks) 4 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-nd-4.0", "creative commons", r"creative commons attribution no ?deriv(?:s|atives|ativeworks) 4 0(?: [a-z]+)?(?: licen[cs]e)?"),
    ("cc-by-2.0", "cc by", r"cc by 2 0"),
    ("cc-by-3.0", "cc by", r"cc by 3 0"),
    ("cc-by-4.0", "cc by", r"cc by 4 0"),
    ("cc-by-sa-3.0", "cc by sa", r"cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa", r"cc by sa 4 0"),
    ("cc-by-sa", "cc by sa", r"cc by sa"),
    ("cc-by-nc-2.0", "cc by nc", r"cc by nc 2 0"),
    ("cc-by-nc-3.0", "cc by nc", r"cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc by nc", r"cc by nc 4 0"),
    ("cc-by-nc", "cc by nc", r"cc by nc"),
    ("cc-by-nc-sa-3.0", "cc by nc", r"cc by nc sa 3 0"),
    ("cc-by-nc-sa-4.0", "cc by nc", r"cc by nc sa 4 0"),
    ("cc-by-nc-nd-3.0", "cc by nc", r"cc by nc nd 3 0"),
    ("cc-by-nc-nd-4.0", "cc by nc", r"cc by nc nd 4 0"),
    ("cc-by-nd-4.0", "cc by nd", r"cc by nd 4 0"),
    ("cddl-1.0", "common development", r"common development and distribution licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("cddl-1.1", "common development", r"common development and distribution licen[cs]e(?: v| version)? ?1 1"),
    ("cddl-1.0", "cddl", r"cddl(?: 1 0)?"),
    ("cecill-2.1", "cecill|cecill2", r"cecill(?: free software licen[cs]e)?(?: agreement)?(?: v| version)? ?2 1"),
    ("cecill", "cecill", r"cecill(?: [bc])?(?: licen[cs]e)?"),
    ("cpl-1.0", "common public", r"common public licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("cpal-1.0", "common public attribution", r"common public attribution licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("ecl-2.0", "educational community", r"educational community licen[cs]e(?:(?: v| version)? ?2 0)?"),
    ("efl-2.0", "eiffel forum", r"eiffel forum licen[cs]e(?:(?: v| version)? ?2)?"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e(?:(?: v| version)? ?2(?: 0)?)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: v| version)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: v| version)? ?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("eupl-1.1", "european union public", r"european union public licen[cs]e(?: v| version)? ?1 1"),
    ("eupl-1.2", "european union public", r"european union public licen[cs]e(?: v| version)? ?1 2"),
    ("eupl", "european union public", r"european union public licen[cs]e"),
    ("fdl-1.2", "free documentation", r"(?:gnu )?free documentation licen[cs]e(?: v| version)? ?1 2"),
    ("fdl-1.3", "free documentation", r"(?:gnu )?free documentation licen[cs]e(?: v| version)? ?1 3"),
    ("fdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e"),
    ("ftl", "freetype", r"freetype(?: project)? licen[cs]e"),
    ("gpl-1", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: v| version)? ?1(?: 0)?"),
    ("gpl-2", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: v| version)? ?2(?: 0)?"),
    ("gpl-2-or-later", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)? version 2(?: 0)?(?: of the licen[cs]e)? or (?:at your option )?any later version"),
    ("gpl-3", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: v| version)? ?3(?: 0)?"),
    ("gpl-3-or-later", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?(?: of the licen[cs]e)? or (?:at your option )?any later version"),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e"),
    ("gpl-2", "gpl|gpl2", r"(?:gnu )?gpl(?: v| version)? ?2(?: 0)?"),
    ("gpl-3", "gpl|gpl3", r"(?:gnu )?gpl(?: v| version)? ?3(?: 0)?"),
    ("gpl-2", "gplv2", r"(?:gnu )?gplv2"),
    ("gpl-3", "gplv3", r"(?:gnu )?gplv3"),
    ("gpl", "gnu gpl", r"gnu gpl"),
    ("hpnd", "historical permission", r"historical permission notice and disclaimer"),
    ("icu", "icu", r"icu licen[cs]e"),
    ("ijg", "independent jpeg", r"independent jpeg group licen[cs]e"),
    ("imagemagick", "imagemagick", r"imagemagick licen[cs]e"),
    ("ipl-1.0", "ibm public", r"ibm public licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("json", "json", r"json licen[cs]e"),
    ("lgpl-2", "library general public", r"(?:gnu )?library general public licen[cs]e(?:(?: v| version)? ?2(?: 0)?)?"),
    ("lgpl-2.1", "lesser general public", r"(?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)?(?: v| version)? ?2 1"),
    ("lgpl-3", "lesser general public", r"(?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)?(?: v| version)? ?3(?: 0)?"),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl-2.1", "lgpl|lgpl2", r"(?:gnu )?lgpl(?: v| version)? ?2 1"),
    ("lgpl-3", "lgpl|lgpl3", r"(?:gnu )?lgpl(?: v| version)? ?3(?: 0)?"),
    ("lgpl", "lgpl|lgplv2|lgplv3", r"(?:gnu )?lgpl(?:v2|v3)?"),
    ("libpng", "libpng", r"libpng licen[cs]e"),
    ("llama-2", "llama", r"llama 2(?: community)? licen[cs]e"),
    ("llama-3", "llama", r"llama 3(?: [0-9])?(?: community)? licen[cs]e"),
    ("lppl-1.3", "latex project public", r"latex project public licen[cs]e(?: v| version)? ?1 3(?: ?[ac])?"),
    ("lppl", "latex project public", r"latex project public licen[cs]e"),
    ("mit", "mit", r"mit(?: x11| expat)?(?: style)? licen[cs]e"),
    ("mit", "expat", r"expat licen[cs]e"),
    ("mit-0", "mit", r"mit (?:0|no attribution)(?: licen[cs]e)?"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[cs]e(?: v| version)? ?1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: v| version)? ?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: v| version)? ?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("mpl-2.0", "mpl|mpl2", r"mpl(?: v| version)? ?2(?: 0)?"),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e(?: ms pl)?"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e(?: ms rl)?"),
    ("mulanpsl-2.0", "mulan|mulanpsl|mulanpsl2|mulanpermissive", r"mulan ?(?:psl|permissive software licen[cs]e)(?: v| version)? ?2"),
    ("naist-2003", "naist", r"naist licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("nposl-3.0", "non profit open", r"non profit open software licen[cs]e(?:(?: v| version)? ?3 0)?"),
    ("odbl-1.0", "open database", r"open (?:data commons open )?database licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e(?:(?: v| version)? ?1 1)?"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("osl-2.1", "open software", r"open software licen[cs]e(?: v| version)? ?2 1"),
    ("osl-3.0", "open software", r"open software licen[cs]e(?:(?: v| version)? ?3 0)?"),
    ("pddl-1.0", "public domain dedication", r"(?:open data commons )?public domain dedication and licen[cs]e"),
    ("php-3.01", "php", r"php licen[cs]e(?:(?: v| version)? ?3 01)?"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("psf-2.0", "python software", r"python software foundation licen[cs]e(?:(?: v| version)? ?2)?"),
    ("qpl-1.0", "q public", r"q public licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("openrail-m", "rail|openrail", r"(?:bigscience |creativeml )?open ?rail(?: [m]| m)? licen[cs]e"),
    ("rpl-1.5", "reciprocal public", r"reciprocal public licen[cs]e(?:(?: v| version)? ?1 5)?"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("sissl", "sun industry", r"sun industry standards source licen[cs]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[cs]e"),
    ("sspl-1.0", "server side public", r"server side public licen[cs]e(?:(?: v| version)? ?1)?"),
    ("tcl", "tcl", r"tcl tk licen[cs]e"),
    ("unicode", "unicode", r"unicode licen[cs]e(?: agreement)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[cs]e(?:(?: v| version)? ?1 0)?"),
    ("vim", "vim", r"vim licen[cs]e"),
    ("w3c", "w3c", r"w3c(?: software(?: notice)?(?: and)?)? licen[cs]e"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("wtfpl", "what the fuck", r"do what the fuck you want to public licen[cs]e"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("zpl-2.1", "zope", r"zope public licen[cs]e(?:(?: v| version)? ?2 1)?"),
)

# Label, keyword, pattern, certainty. Sentences of licence texts and addresses.
SENTENCES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 1.0),
    ("x11", "name of the x consortium", r"except as contained in this notice the name of the x consortium shall not be used", 0.9),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", 0.95),
    ("bsd-3-clause", "endorse or promote", r"neither the name of [^.]{1,80}? may be used to endorse or promote products derived from this software", 0.9),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledg[e]?ment", 0.95),
    ("isc", "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", 0.95),
    ("0bsd", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", 0.9),
    ("apache-2", "licensed under the apache", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", 1.0),
    ("gpl-2-or-later", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", 1.0),
    ("gpl-3-or-later", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", 1.0),
    ("lgpl-2.1-or-later", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", 1.0),
    ("lgpl-3-or-later", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", 1.0),
    ("agpl-3-or-later", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", 1.0),
    ("gpl", "without any warranty", r"distributed in the hope that it will be useful but without any warranty", 0.6),
    ("mpl-2.0", "subject to the terms", r"this source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
    ("mpl-1.1", "contents of this file", r"the contents of this file are subject to the mozilla public license version 1 1", 1.0),
    ("epl-1.0", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", 1.0),
    ("epl-2.0", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", 1.0),
    ("bsl-1.0", "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 0.95),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain", 1.0),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 0.95),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain", 0.8),
    ("cc0-1.0", "no copyright reserved|waived all copyright", r"no copyright reserved|waived all copyright and related or neighboring rights", 0.8),
    ("proprietary", "all rights reserved", r"all rights reserved", 0.5),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential", 0.8),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this file via any medium is strictly prohibited", 0.95),
    ("proprietary", "end user license", r"end user license agreement", 0.7),
    ("proprietary", "may not be reproduced", r"may not be reproduced (?:in whole or in part )?without (?:the )?(?:prior |express )?(?:written )?permission", 0.7),
    ("non-commercial", "non commercial", r"for non commercial (?:use|purposes|research)(?: only)?", 0.6),
    ("non-commercial", "noncommercial", r"for noncommercial (?:use|purposes|research)(?: only)?", 0.6),
    ("research-only", "research", r"for (?:academic |scientific )?research (?:use|purposes) only", 0.6),
    ("mit", "opensource org", r"opensource org licen[cs]es mit(?: license(?: php| html)?)?", 0.9),
    ("bsd-2-clause", "opensource org", r"opensource org licen[cs]es bsd 2 clause", 0.9),
    ("bsd-3-clause", "opensource org", r"opensource org licen[cs]es bsd 3 clause", 0.9),
    ("isc", "opensource org", r"opensource org licen[cs]es isc", 0.9),
    ("apache-2", "apache org", r"apache org licenses license 2 0(?: txt| html)?", 0.9),
    ("gpl-2", "gnu org", r"gnu org licenses (?:old licenses )?gpl 2 0(?: txt| html)?", 0.9),
    ("gpl-3", "gnu org", r"gnu org licenses gpl 3 0(?: txt| html)?", 0.9),
    ("gpl", "gnu org", r"gnu org licenses gpl(?: txt| html)?", 0.8),
    ("gpl", "gnu org", r"gnu org copyleft gpl(?: txt| html)?", 0.8),
    ("lgpl-2.1", "gnu org", r"gnu org licenses (?:old licenses )?lgpl 2 1(?: txt| html)?", 0.9),
    ("lgpl-3", "gnu org", r"gnu org licenses lgpl 3 0(?: txt| html)?", 0.9),
    ("agpl-3", "gnu org", r"gnu org licenses agpl 3 0(?: txt| html)?", 0.9),
    ("fdl-1.3", "gnu org", r"gnu org licenses fdl 1 3(?: txt| html)?", 0.9),
    ("mpl-2.0", "mozilla org", r"mozilla org (?:en us )?mpl 2 0", 0.9),
    ("epl-2.0", "eclipse org", r"eclipse org legal epl (?:2 0|v20)", 0.9),
    ("epl-1.0", "eclipse org", r"eclipse org legal epl (?:1 0|v10)", 0.9),
    ("bsl-1.0", "boost org", r"boost org license 1 0 txt", 0.9),
    ("unlicense", "unlicense org", r"unlicense org", 0.9),
    ("wtfpl", "wtfpl net", r"wtfpl net", 0.9),
    ("ofl-1.1", "scripts sil org", r"scripts sil org ofl", 0.9),
    ("cc0-1.0", "creativecommons org", r"creativecommons org publicdomain zero 1 0", 0.95),
    ("public-domain", "creativecommons org", r"creativecommons org publicdomain mark 1 0", 0.9),
)

# Ids of the short identifier notice, as words, and the address form's parts.
SPDX = (
    "0bsd", "aal", "afl-3.0", "agpl-3.0", "apache-1.1", "apache-2.0", "apsl-2.0", "artistic-1.0",
    "artistic-2.0", "beerware", "blueoak-1.0.0", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause",
    "bsl-1.0", "busl-1.1", "cc-by-3.0", "cc-by-4.0", "cc-by-nc-3.0", "cc-by-nc-4.0",
    "cc-by-nc-nd-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0", "cc-by-sa-3.0", "cc-by-sa-4.0", "cc0-1.0",
    "cddl-1.0", "cddl-1.1", "cecill-2.1", "cpl-1.0", "ecl-2.0", "elastic-2.0", "epl-1.0", "epl-2.0",
    "eupl-1.1", "eupl-1.2", "gfdl-1.3", "gpl-2.0", "gpl-3.0", "hpnd", "ijg", "isc", "lgpl-2.0",
    "lgpl-2.1", "lgpl-3.0", "libpng-2.0", "lppl-1.3c", "mit", "mit-0", "mpl-1.1", "mpl-2.0",
    "ms-pl", "ms-rl", "mulanpsl-2.0", "ncsa", "odbl-1.0", "ofl-1.1", "openssl", "osl-3.0",
    "php-3.01", "postgresql", "psf-2.0", "python-2.0", "qpl-1.0", "ruby", "sspl-1.0", "unlicense",
    "upl-1.0", "vim", "w3c", "wtfpl", "x11", "zlib", "zpl-2.1",
)
SAME_LABEL = {
    "apache-2.0": "apache-2", "gpl-2.0": "gpl-2", "gpl-3.0": "gpl-3", "agpl-3.0": "agpl-3",
    "lgpl-2.0": "lgpl-2", "lgpl-3.0": "lgpl-3", "gfdl-1.3": "fdl-1.3",
}
COMMONS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

NOTICE = (
    r"(?:(?:is|are) )?(?:dual )?(?:licen[cs]ed|released|distributed|available|provided|published|covered|redistributed|used)"
    r"(?: [a-z]+)? (?:under|by|with) (?:the )?(?:(?:terms|conditions) (?:and conditions )?of )?(?:the )?(?:latest )?(?:gnu )?"
)
DENIED = r"not (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?"


@dataclass(frozen=True)
class Rule:
    """``label`` None marks a rule that only takes the place of what it contains."""

    label: str | None
    keyword: bytes
    pattern: re.Pattern[bytes]
    priority: int  # lower goes before
    certainty: float
    more_keywords: tuple[bytes, ...] = ()  # any of them will do


def _rule(label: str | None, keyword: str, pattern: str, priority: int, certainty: float) -> Rule:
    whole = rf"(?<= )(?:{pattern})(?= )"
    first, *more = (f" {k} ".encode() for k in keyword.split("|"))
    return Rule(label, first, re.compile(whole.encode()), priority, certainty, tuple(more))


def _words(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", name)


def rules() -> list[Rule]:
    """All rules by priority: denials, identifiers, sentences and addresses, notices, names."""
    made = []
    for label, keyword, name in NAMES:
        made.append(_rule(None, keyword, DENIED + name, 0, 0.0))
        made.append(_rule(label, keyword, NOTICE + name, 3, 0.95))
        made.append(_rule(label, keyword, name, 4, 0.7))
    for name in SPDX:
        label = SAME_LABEL.get(name, name)
        head = r"spdx license identifier "
        made.append(_rule(label, "spdx license identifier", head + _words(name) + "(?: only)?", 1, 1.0))
        made.append(
            _rule(f"{label}-or-later", "spdx license identifier", head + _words(name) + " or later", 1, 1.0)
        )
    for label, keyword, pattern, certainty in SENTENCES:
        made.append(_rule(label, keyword, pattern, 2, certainty))
    for terms in COMMONS:
        for version in COMMONS_VERSIONS:
            address = f"creativecommons org licenses {_words(terms)} {_words(version)}"
            made.append(_rule(f"cc-{terms}-{version}", "creativecommons org", address, 2, 0.95))
    return sorted(made, key=lambda r: r.priority)
