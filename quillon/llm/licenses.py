"""License scan by ordered signature rules, in DataFrame functions only.

Texts are reduced to words of lower-case ASCII letters, digits and non-ASCII characters. A rule is a regular expression over
these words with keywords of which every match holds one, a label and a priority: some two hundred sentences and names out of
license texts and notices, each written by hand, and the names and versions of license families in the ways that they are stated. Only rows that hold any
keyword go further; of the rules, only those of whose keywords the text holds one are matched. A match is an interval of words; one that lies inside an
interval of a rule of higher priority, or of a longer one of equal priority, is suppressed. Base labels always stay.

Places are sums of the gaps and matches before them, and an interval is suppressed by the widest ones that start before it; both
are running sums and maxima over arrays, in passes that double their reach, so a text of n matches costs n log n.

Defined results: a null or empty text has no words and no label; repeated rows are scanned one by one; empty tables give
empty results; input columns named like a result column are replaced, all others stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import boxed, unboxed

#: Base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Families: label, keyword (or several), the regular expression of the name, and the versions that have texts of their own.
# Versions are written as words ("2 0"); the rules below combine names, versions and ways to state a license.
FAMILIES = (
    ("apache", "apache", r"apache(?: software)?(?: public)?", ("1 0", "1 1", "2 0")),
    ("gpl", "general public", r"(?:gnu )?general public", ("1", "2", "3")),
    ("lgpl", ("lesser general", "library general"), r"(?:gnu )?(?:lesser|library) general public", ("2", "2 1", "3")),
    ("agpl", "affero", r"(?:gnu )?affero general public", ("1", "3")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla", r"mozilla public", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", r"eclipse public", ("1 0", "2 0")),
    ("cddl", "common development", r"common development and distribution", ("1 0", "1 1")),
    ("cpl", "common public", r"common public", ("1 0",)),
    ("eupl", "european union public", r"european union public", ("1 0", "1 1", "1 2")),
    ("osl", "open software", r"open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", r"academic free", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("artistic", "artistic", r"(?:perl )?artistic", ("1 0", "2 0")),
    ("bsl", "boost", r"boost software", ("1 0",)),
    ("zpl", "zope", r"zope public", ("1 1", "2 0", "2 1")),
    ("psf", "python software foundation", r"python software foundation", ("2",)),
    ("php", "php", r"php", ("3 0", "3 01")),
    ("ofl", "open font", r"(?:sil )?open font", ("1 0", "1 1")),
    ("cecill", "cecill", r"cecill(?: free software)?", ("1 0", "1 1", "2 0", "2 1")),
    ("lppl", "latex project", r"latex project public", ("1 0", "1 1", "1 2", "1 3")),
    ("mspl", "microsoft public", r"microsoft public", ()),
    ("msrl", "microsoft reciprocal", r"microsoft reciprocal", ()),
    ("unlicense", "unlicense", r"unlicense", ()),
    ("zlib", "zlib", r"zlib(?: libpng)?", ()),
    ("isc", "isc", r"isc", ()),
    ("mit", ("mit licen", "under mit", "under the mit", "terms of mit", "terms of the mit"), r"mit", ()),
    ("x11", "x11", r"x11", ()),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", ()),
    ("bsd-2", ("bsd", "freebsd"), r"(?:(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd)", ()),
    ("bsd-3", "bsd", r"(?:(?:3|three) clause bsd|bsd (?:3|three) clause|new bsd|modified bsd)", ()),
    ("bsd-4", "bsd", r"(?:(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd)", ()),
    ("bsd", "bsd", r"bsd", ()),
    ("wtfpl", "do what the", r"do what the \S+ you want to public", ("1", "2")),
    ("ecl", "educational community", r"educational community", ("1 0", "2 0")),
    ("upl", "universal permissive", r"universal permissive", ("1 0",)),
    ("mulan", "mulan", r"mulan (?:psl|permissive software)", ("1", "2")),
    ("sspl", "server side public", r"server side public", ("1",)),
    ("busl", "business source", r"business source", ("1 0", "1 1")),
    ("elastic", "elastic", r"elastic", ("1 0", "2 0")),
    ("odbl", ("open database", "commons database"), r"open (?:data commons )?(?:open )?database", ("1 0",)),
    ("ipl", "ibm public", r"ibm public", ("1 0",)),
    ("qpl", "q public", r"q public", ("1 0",)),
)
# Creative Commons parts: suffix of the label, initials, words.
CC_PARTS = (
    ("by", r"by", r"attribution"),
    ("by-sa", r"by sa", r"attribution share ?alike"),
    ("by-nc", r"by nc", r"attribution non ?commercial"),
    ("by-nd", r"by nd", r"attribution no ?deriv(?:ative|ative works|atives|s)"),
    ("by-nc-sa", r"by nc sa", r"attribution non ?commercial share ?alike"),
    ("by-nc-nd", r"by nc nd", r"attribution non ?commercial no ?deriv(?:ative|ative works|atives|s)"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Sentences of license texts, and licenses that are one name: label, keyword (or several), regular expression.
SENTENCES = (
    ("mit", "person obtaining", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "without restriction", r"to deal in the software without restriction(?: including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies)?"),
    ("mit", "substantial portions", r"this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "copyright holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit-0", "mit no attribution", r"mit no attribution(?: licen[cs]e)?"),
    ("mit-0", "mit 0", r"mit 0 licen[cs]e"),
    ("x11", "except as contained", r"except as contained in this notice the names? of (?:\S+ ){1,8}shall not be used in advertising"),
    ("bsd", "redistributions of", r"redistributions of source code must retain the(?: above)? copyright notice(?: this list of conditions and the following disclaimer)?"),
    ("bsd", "redistributions in", r"redistributions in binary form must reproduce the(?: above)? copyright notice"),
    ("bsd-3", "neither the name", r"neither the name of (?:\S+ ){1,8}may be used to endorse or promote products"),
    ("bsd-4", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "software is provided by", r"this software is provided by the (?:regents|authors?|copyright holders?|copyright owners?)(?: and contributors)? as is"),
    ("0bsd", ("zero clause", "bsd zero", "0bsd"), r"(?:zero clause bsd|bsd zero clause|0bsd)(?: licen[cs]e)?"),
    ("bsd-patent", "bsd 2 clause plus", r"bsd 2 clause plus patent(?: licen[cs]e)?"),
    ("bsd-clear", "clear bsd", r"clear bsd licen[cs]e"),
    ("isc", "with or without fee", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "author disclaims", r"the software is provided as is and the author disclaims all warranties"),
    ("apache-2.0", "in compliance with", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache org", r"(?:http|https) www apache org licenses license 2 0(?: txt| html)?"),
    ("apache-2.0", "unless required by", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "grant of patent", r"grant of patent license subject to the terms and conditions of this license"),
    ("apache-1.1", "apache", r"this product includes software developed by the apache (?:software foundation|group)"),
    ("gpl", "free software you", r"this (?:program|file|package) is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "free software you", r"this (?:library|program) is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "free software you", r"this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "hope that it", r"(?:program|software) is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "should have received", r"you should have received a copy of the gnu general public license"),
    ("lgpl", "should have received", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("agpl", "should have received", r"you should have received a copy of the gnu affero general public license"),
    ("gpl-2", "either version 2", r"either version 2 of the license or at your option any later version"),
    ("gpl-3", "either version 3", r"either version 3 of the license or at your option any later version"),
    ("gpl", "verbatim copies of this", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl-2", ("gplv2", "gpl v2", "gpl 2"), r"(?:gplv2|gpl v2|gpl 2(?: 0)?)(?: only| or later)?(?! [0-9])"),
    ("gpl-3", ("gplv3", "gpl v3", "gpl 3"), r"(?:gplv3|gpl v3|gpl 3(?: 0)?)(?: only| or later)?(?! [0-9])"),
    ("lgpl-2.1", ("lgplv2", "lgpl v2", "lgpl 2"), r"(?:lgplv2 1|lgpl v2 1|lgpl 2 1)(?: only| or later)?"),
    ("lgpl-3", ("lgplv3", "lgpl v3", "lgpl 3"), r"(?:lgplv3|lgpl v3|lgpl 3(?: 0)?)(?: only| or later)?(?! [0-9])"),
    ("agpl-3", ("agplv3", "agpl v3", "agpl 3"), r"(?:agplv3|agpl v3|agpl 3(?: 0)?)(?: only| or later)?(?! [0-9])"),
    ("gpl", "gnu gpl", r"gnu gpl(?: licen[cs]e)?"),
    ("gpl-classpath-exception", "classpath", r"(?:classpath exception|gnu classpath)"),
    ("gpl-linking-exception", "making a combined", r"linking this library statically or dynamically with other modules is making a combined work"),
    ("gcc-exception", "runtime library exception", r"gcc runtime library exception"),
    ("agpl-3", "interacting with it", r"offer all users interacting with it remotely through a computer network"),
    ("gfdl", "this document under", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "invariant sections", r"with no invariant sections(?: no front cover texts and no back cover texts)?"),
    ("mpl-2.0", "source code form is", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "subject to the mozilla", r"the contents of this file are subject to the mozilla public license"),
    ("mpl-2.0", "copy of the mpl", r"if a copy of the mpl was not distributed with this file"),
    ("epl", "eclipse", r"accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("zlib", "held liable for", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "origin of this", r"the origin of this software must not be misrepresented"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such"),
    ("zlib", "removed or altered", r"this notice may not be removed or altered from any source distribution"),
    ("bsl-1.0", "person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("bsl-1.0", "boost", r"distributed under the boost software license(?: version 1 0)?"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0", "extent possible", r"to the extent possible under law (?:\S+ ){1,8}waived all copyright and related or neighboring rights"),
    ("wtfpl", "verbatim or modified", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("artistic-1.0", "intent of this", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "terms as perl", r"under the same terms as perl(?: itself)?"),
    ("psf-2", "psf is making", r"psf is making python (?:\S+ ){0,3}available to licensee on an as is basis"),
    ("beopen", "beopen", r"beopen python open source license"),
    ("openssl", "openssl", r"software developed by the openssl project(?: for use in the openssl toolkit)?"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("ssleay", "cryptographic software", r"this product includes cryptographic software written by"),
    ("ruby", "verbatim copies of the source", r"you may make and give away verbatim copies of the source form of the software without restriction"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("php", "php", r"this product includes php software freely available"),
    ("ofl", "font software", r"this font software is licensed under the sil open font license"),
    ("ofl", "reserved font", r"with reserved font names?"),
    ("json", "good not evil", r"the software shall be used for good not evil"),
    ("beerware", ("beerware", "beer ware"), r"(?:beerware|beer ware) licen[cs]e"),
    ("beerware", "buy me a beer", r"you think this stuff is worth it you can buy me a beer"),
    ("sleepycat", "sleepycat", r"sleepycat licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("postgresql", "without fee and", r"for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "historical permission", r"historical permission notice and disclaimer"),
    ("hpnd", "its documentation for", r"permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("libtiff", "distribute and sell", r"permission to use copy modify distribute and sell this software and its documentation for any purpose"),
    ("libpng", "png reference", r"png reference library licen[cs]e"),
    ("libpng", "libpng", r"libpng licen[cs]e(?: version 2)?"),
    ("curl", "curl", r"curl licen[cs]e"),
    ("unicode", "unicode", r"unicode (?:licen[cs]e|terms of use)(?: agreement)?"),
    ("unicode", "unicode data", r"unicode data files (?:and|or) software"),
    ("w3c", "w3c", r"w3c software(?: and document)?(?: notice and)? licen[cs]e"),
    ("w3c", "w3c", r"w3c document licen[cs]e"),
    ("ntp", "ntp", r"ntp licen[cs]e"),
    ("vim", "vim licen", r"vim licen[cs]e"),
    ("tcl", "tcl", r"tcl(?: tk)? licen[cs]e"),
    ("sgi-b", "sgi free", r"sgi free software licen[cs]e b(?: version [12] [01])?"),
    ("info-zip", "info zip", r"info zip licen[cs]e"),
    ("bzip2", "bzip2", r"bzip2(?: and libbzip2)? licen[cs]e"),
    ("imagemagick", "imagemagick", r"imagemagick licen[cs]e"),
    ("ijg", "independent jpeg", r"independent jpeg group(?: s)? (?:software|licen[cs]e)"),
    ("ijg", "independent jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", "freetype", r"freetype(?: project)? licen[cs]e"),
    ("freetype", "freetype", r"portions of this software are copyright (?:\S+ ){0,4}the freetype project"),
    ("blueoak", "blue oak", r"blue oak model licen[cs]e(?: 1 0 0)?"),
    ("efl", "eiffel", r"eiffel forum licen[cs]e"),
    ("zend", "zend", r"zend engine licen[cs]e"),
    ("fair", "fair license", r"fair license"),
    ("nasa", "nasa open", r"nasa open source agreement(?: version 1 3)?"),
    ("intel", "intel", r"intel(?: simplified software| open source) licen[cs]e"),
    ("apsl", "apple public", r"apple public source licen[cs]e"),
    ("nokia", "nokia open", r"nokia open source licen[cs]e"),
    ("sissl", "sun industry", r"sun industry standards source licen[cs]e"),
    ("spl", "sun public", r"sun public licen[cs]e"),
    ("rpl", "reciprocal public", r"(?<!microsoft )reciprocal public licen[cs]e"),
    ("npl", "netscape", r"netscape public licen[cs]e"),
    ("watcom", "open watcom", r"(?:sybase )?open watcom public licen[cs]e"),
    ("lucent", "lucent public", r"lucent public licen[cs]e"),
    ("ricoh", "ricoh source", r"ricoh source code public licen[cs]e"),
    ("vovida", "vovida", r"vovida software licen[cs]e"),
    ("realnetworks", "realnetworks", r"realnetworks public source licen[cs]e"),
    ("jabber", "jabber open", r"jabber open source licen[cs]e"),
    ("cpal", "public attribution", r"common public attribution licen[cs]e"),
    ("cryptix", "cryptix", r"cryptix(?: general)? licen[cs]e"),
    ("entessa", "entessa", r"entessa public licen[cs]e"),
    ("liliq", "libre du", r"licence libre du qu[ée]bec"),
    ("openldap", "openldap", r"openldap public licen[cs]e"),
    ("simpl", "simple public", r"simple public licen[cs]e"),
    ("sugarcrm", "sugarcrm", r"sugarcrm public licen[cs]e"),
    ("ypl", "yahoo public", r"yahoo public licen[cs]e"),
    ("zimbra", "zimbra", r"zimbra public licen[cs]e"),
    ("hippocratic", "hippocratic", r"hippocratic licen[cs]e"),
    ("anti-996", "anti 996", r"anti 996 licen[cs]e"),
    ("commons-clause", "commons clause", r"commons clause(?: licen[cs]e condition)?"),
    ("confluent", "confluent", r"confluent community licen[cs]e"),
    ("prosperity", "prosperity public", r"prosperity public licen[cs]e"),
    ("parity", "parity public", r"parity public licen[cs]e"),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|perimeter|shield|strict|internal use) licen[cs]e"),
    ("fair-source", "fair source", r"fair source licen[cs]e"),
    ("fsl", "functional source", r"functional source licen[cs]e"),
    ("openrail", ("openrail", "open rail", "rail license"), r"(?:(?:creativeml|bigscience|bigcode) )?(?:openrail(?: m)?|open rail(?: m)?|rail license)"),
    ("free-art", "free art", r"free art licen[cs]e"),
    ("free-art", "art libre", r"licence art libre"),
    ("odc-by", "commons attribution", r"open data commons attribution licen[cs]e"),
    ("pddl", "domain dedication and", r"public domain dedication and licen[cs]e"),
    ("cdla", "community data", r"community data licen[cs]e agreement(?: (?:permissive|sharing))?"),
    ("ogl", "open government", r"open government licen[cs]e"),
    ("ogl", "public sector information", r"contains public sector information licensed under"),
    ("data-licence-germany", "datenlizenz", r"datenlizenz deutschland(?: namensnennung| zero)?"),
    ("etalab", "etalab", r"(?:licence ouverte )?etalab(?: open licence)?"),
    ("design-science", "design science", r"design science licen[cs]e"),
    ("open-publication", "open publication", r"open publication licen[cs]e"),
    ("ogl-game", "open game", r"open game licen[cs]e"),
    ("opl", "open content", r"open content licen[cs]e"),
    ("cc", "creative commons", r"licensed under a creative commons(?: attribution)?(?: licen[cs]e)?"),
    ("cc", "creative commons", r"except where otherwise noted content on this site is licensed under a creative commons"),
    ("cc-sampling", "sampling plus", r"creative commons sampling plus"),
)
# Notices: label, keyword (or several), regular expression. What repeats without bound does so possessively: a matcher that may
# give back recurses once a repetition.
NOTICES = (
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative commons", r"creative commons (?:zero|public domain dedication)"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed|is|in)(?: in| into| to)?(?: the)? public domain"),
    ("copyright", "copyright", r"copyright(?: c)?(?: by)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2}(?= ))*+"),
    ("copyright", "copyright", r"c copyright"),
    ("copyright", "protected by copyright", r"(?:is|are) protected by copyright(?: law| laws)?"),
    ("crown-copyright", "crown copyright", r"crown copyright"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "confidential", r"confidential and proprietary"),
    ("proprietary", "unauthori", r"unauthori[sz]ed (?:copying|reproduction|distribution|duplication|use)(?: or (?:copying|reproduction|distribution|duplication|use))?(?: of this (?:file|document|material|software))?(?: via any medium)? is(?: strictly)? (?:prohibited|forbidden)"),
    ("proprietary", "trade secret", r"(?:contains|constitutes|is a|are) trade secrets?"),
    ("no-redistribution", tuple(f"{no} {what}" for no in ("may not", "must not", "do not") for what in ("copy", "be copied", "redistribut", "be redistribut")), r"(?:may not|must not|do not) (?:copy|be copied|redistribute|be redistributed)(?: or (?:redistribute|distribute|be distributed))?"),
    ("no-redistribution", "not for", r"not for (?:redistribution|resale|distribution)"),
    ("no-redistribution", "published broadcast", r"may not be published broadcast rewritten or redistributed"),
    ("no-reproduction", "no part of", r"no part of this (?:publication|book|document|work|material|website|site) may be reproduced"),
    ("no-reproduction", "in whole or", r"reproduction in whole or in part(?: without(?: written)? permission)? is(?: strictly)? (?:prohibited|forbidden)"),
    ("some-rights", "some rights", r"some rights reserved"),
    ("no-rights", "no rights", r"no rights reserved"),
    ("all-wrongs", "wrongs", r"all wrongs reserved"),
    ("alle-rechte", "alle rechte", r"alle rechte vorbehalten"),
    ("tous-droits", "tous droits", r"tous droits r[ée]serv[ée]s"),
    ("todos-derechos", "todos los", r"todos los derechos reservados"),
    ("permission-notice", "permission", r"permission is hereby granted free of charge to any person"),
    ("redistribution-notice", "redistribution", r"redistribution and use in source and binary forms"),
    ("warranty-disclaimer", "provided as is", r"(?:is|are) provided as is(?: without warranty of any kind)?"),
    ("warranty-disclaimer", "implied warranties", r"implied warranties of merchantability(?: and fitness for a particular purpose)?"),
    ("terms-of-use", "terms", r"(?:subject to|under)(?: the)? terms (?:of use|of service|and conditions)"),
    ("terms-of-use", "by using this", r"by using this (?:site|website|service|software) you (?:agree|accept|consent)"),
    ("terms-of-use", "terms and conditions", r"terms and conditions apply"),
    ("eula", "end user", r"end user licen[cs]e agreement"),
    ("used-by-permission", "permission", r"(?:used|reprinted|reproduced) (?:by|with)(?: kind)? permission"),
    ("reprint", "reprinted from", r"reprinted from"),
    ("non-commercial", ("commercial use", "noncommercial use"), r"for non ?commercial use only"),
    ("non-commercial", ("non commercial purposes", "noncommercial purposes"), r"for (?:non commercial|noncommercial) purposes only"),
    ("personal-use", "personal use", r"for personal use only"),
    ("internal-use", "internal use", r"for internal use only"),
    ("research-use", "research", r"for research (?:purposes|use) only"),
    ("educational-use", "educational", r"for educational (?:purposes|use) only"),
    ("academic-use", "academic", r"for academic (?:purposes|use) only"),
    ("evaluation-use", "evaluation", r"for evaluation (?:purposes|use) only"),
    ("freeware", "freeware", r"(?:is|as) freeware"),
    ("shareware", "shareware", r"(?:is|as) shareware"),
    ("royalty-free", "royalty free", r"royalty free licen[cs]e"),
    ("rights-managed", "rights managed", r"rights managed licen[cs]e"),
    ("attribution", "attribution", r"attribution (?:is )?required"),
    ("copyleft", "copyleft", r"copyleft(?: licen[cs]e)?"),
    ("dual-license", ("dual licensed", "dually licensed"), r"(?:dual|dually) licensed under"),
    ("open-source", "open source license", r"(?:approved )?open source license"),
    ("us-government", "united states government", r"work of the united states government"),
    ("us-government", "copyright protection in", r"not subject to copyright protection in the united states"),
    ("trademark", "trademarks", r"trademarks (?:are the property of|of) their respective owners"),
    ("trademark", "registered trademark", r"(?:is a|are) registered trademarks? of"),
    ("patent", "patent", r"patents? pending"),
    ("dmca", "dmca", r"dmca (?:notice|takedown)"),
)


@dataclass(frozen=True)
class Signature:
    label: str
    keywords: str | tuple[str, ...]
    pattern: str
    priority: int

    def __post_init__(self):
        if isinstance(self.keywords, str):
            object.__setattr__(self, "keywords", (self.keywords,))


def signatures() -> list[Signature]:
    """The rules, most specific first: 4 a version, then 3 a stated family, 2 a named one, 1 a notice."""
    out = []
    for label, keyword, name, versions in FAMILIES:
        for v in versions:
            plain = v.removesuffix(" 0")
            exact = f"{plain}(?: 0)?" if v.endswith(" 0") else v
            out.append(Signature(f"{label}-{v.replace(' ', '.')}", keyword, rf"{name} licen[cs]e (?:version |v ?|version v)?{exact}(?! [0-9])(?: or(?: at your option any)? later(?: version)?)?", 4))
            out.append(Signature(f"{label}-{v.replace(' ', '.')}", keyword, rf"{name} (?:version |v ?){exact}(?! [0-9])", 4))
            out.append(Signature(f"{label}-{v.replace(' ', '.')}", keyword, rf"version {exact} of the {name} licen[cs]e", 4))
        out.append(Signature(label, keyword, rf"(?:licensed|released|distributed|available|published|provided) under(?: the)?(?: terms of(?: the)?)? {name}(?: licen[cs]e)?", 3))
        out.append(Signature(label, keyword, rf"{name} licen[cs]e", 2))
    for part, initials, words in CC_PARTS:
        for v in CC_VERSIONS:
            out.append(Signature(f"cc-{part}-{v.replace(' ', '.')}", "cc by", rf"cc {initials} {v}(?! [0-9])(?: international| unported)?", 4))
            out.append(Signature(f"cc-{part}-{v.replace(' ', '.')}", "creative commons", rf"creative commons {words} {v}(?! [0-9])(?: international| unported)?", 4))
        out.append(Signature(f"cc-{part}", "creative commons", rf"creative commons {words}(?: licen[cs]e)?(?! (?:share|non|no))", 3))
        out.append(Signature(f"cc-{part}", "cc by", rf"cc {initials}(?! (?:sa|nc|nd))", 2))
    spdx = [(f"{label}-{v.replace(' ', '.')}", f"{label.replace('-', ' ')} {v}") for label, _, _, versions in FAMILIES for v in versions]
    spdx += [(label, label.replace("-", " ")) for label, _, _, versions in FAMILIES if not versions]
    out += [Signature(label, "spdx", rf"spdx licen[cs]e identifier {words}(?: (?:only|or later))?", 5) for label, words in spdx]
    out += [Signature(label, keyword, pattern, 3) for label, keyword, pattern in SENTENCES]
    return out + [Signature(label, keyword, pattern, 1) for label, keyword, pattern in NOTICES]


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def by_letters(words: list[str]) -> str:
    """An alternation that matches where one of these words begins, and tries at a place only those of the letters met there."""
    if "" in words:
        return ""
    groups: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        groups.setdefault(word[0], []).append(word[1:])
    each = [first + by_letters(rest) for first, rest in groups.items()]
    return each[0] if len(each) == 1 else f"(?:{'|'.join(each)})"


def word_text(text: Column) -> Column:
    """Words joined and surrounded by one space; one space where there is none."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def running(array: str, combine: str, least: str) -> str:
    """SQL for the running combination of an array: in each pass every value takes in the one that lies twice as far before it."""
    return f"""aggregate(sequence(0, length(bin(size({array}))) - 1), {array}, (acc, d) -> transform(acc, (x, i) -> {combine.format("x", f"ifnull(get(acc, i - shiftleft(1, d)), {least})")}))"""


def scan_licenses(docs: DataFrame) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels, score, and hits (label, first word, words)."""
    rules = signatures()
    spaces = lambda x: f"(length({x}) - length(replace({x}, ' ', '')))"
    gates = sorted({r.keywords for r in rules})
    keywords = sorted({k for gate in gates for k in gate})
    base = " (?:" + "|".join(p for p, _ in BASE) + ")(?= )"
    own = boxed(docs, word_text(F.col("text")).alias("_t")).withColumn("_words", F.expr(f"cast({spaces('_t')} - 1 as bigint)"))
    own = own.withColumn("_gated", F.col("_t").rlike(" " + by_letters(keywords + [p for p, _ in BASE])))
    own = own.withColumn("_places", F.when(F.col("_gated"), F.split("_t", base)))
    own = own.withColumn("_found", F.when(F.size("_places") > 1, F.regexp_extract_all("_t", F.lit(base), F.lit(0))))
    of = lambda k: ", ".join(f"named_struct('label', {_sql(r.label)}, 'pattern', {_sql(f' (?:{r.pattern})(?= )')}, 'priority', {r.priority})" for r in rules if r.keywords == k)
    table = ", ".join(f"named_struct('keywords', array({', '.join(_sql(' ' + k) for k in gate)}), 'rules', array({of(gate)}))" for gate in gates)
    # Each list of keywords is looked for once; only the rules of those that the text holds are tried.
    own = own.withColumn("_rules", F.when(F.col("_gated"), F.expr(f"flatten(transform(filter(array({table}), g -> exists(g.keywords, k -> contains(_t, k))), g -> filter(g.rules, r -> regexp_like(_t, r.pattern))))")))
    # Each match as an interval of words: the words of the pieces and matches before it are its start.
    own = own.withColumn(
        "_matched",
        F.expr(f"""transform(_rules, r -> named_struct('label', r.label, 'priority', r.priority,
            'gaps', transform(split(_t, r.pattern), x -> {spaces('x')}), 'runs', transform(regexp_extract_all(_t, r.pattern, 0), x -> {spaces('x')})))"""),
    )
    own = own.withColumn("_matched", F.expr("transform(_matched, r -> named_struct('label', r.label, 'priority', r.priority, 'runs', r.runs, 'steps', transform(r.runs, (n, k) -> get(r.gaps, k) + ifnull(get(r.runs, k - 1), 0))))"))
    starts = running("r.steps", "{} + {}", "0")
    # In order of start, then of falling end and priority: whatever may suppress an interval stands before it.
    own = own.withColumn(
        "_hits",
        F.expr(f"""sort_array(flatten(transform(transform(_matched, r -> named_struct('label', r.label, 'priority', r.priority, 'runs', r.runs, 'starts', {starts})),
            r -> transform(r.runs, (n, k) -> named_struct('start', get(r.starts, k), 'below', -get(r.starts, k) - n, 'rank', -r.priority, 'label', r.label, 'words', n)))))"""),
    )
    # The farthest end (then the first start) of any interval of a priority so far; one number holds both.
    reach = lambda x: f"(cast(-{x}.below as bigint) * 2147483648L - {x}.start)"
    priorities = sorted({r.priority for r in rules})
    for p in priorities:
        own = own.withColumn(f"_reach{p}_", F.expr(f"case when size(_hits) > 1 then transform(_hits, h -> case when h.rank = {-p} then {reach('h')} else -1L end) end"))
        own = own.withColumn(f"_reach{p}", F.expr(running(f"_reach{p}_", "greatest({}, {})", "-1L")))
    covered = " or ".join(f"(-a.rank < {p} and get(_reach{p}, i - 1) >= {reach('a')}) or (-a.rank = {p} and get(_reach{p}, i - 1) > {reach('a')})" for p in priorities)
    own = own.withColumn("_kept", F.expr(f"case when size(_hits) > 1 then filter(_hits, (a, i) -> not ifnull({covered}, false)) else _hits end"))
    lookup = "map(" + ", ".join(f"{_sql(' ' + p)}, {_sql(v)}" for p, v in BASE) + ")"
    own = own.withColumn("_base", F.expr(f"array_sort(array_distinct(transform(ifnull(_found, cast(array() as array<string>)), x -> element_at({lookup}, x))))"))
    own = own.withColumn("_all", F.expr("array_sort(array_distinct(concat(_base, ifnull(transform(_kept, h -> h.label), cast(array() as array<string>)))))"))
    return unboxed(
        own,
        docs.columns,
        {
            "n_words": F.col("_words"),
            "n_base": F.expr("cast(case when _found is null then 0 else size(_found) end as bigint)"),
            "first_word": F.expr(f"case when _found is not null then cast({spaces('_places[0]')} as bigint) end"),
            "last_word": F.expr(f"case when _found is not null then cast(_words - ({spaces('element_at(_places, -1)')} - 1) - {spaces('element_at(_found, -1)')} as bigint) end"),
            "base_labels": F.array_join("_base", ","),
            "labels": F.array_join("_all", ","),
            "score": F.expr("cast(case when size(_all) = 0 then 0 else greatest(if(size(_base) > 0, 0.5, 0.0), ifnull(array_max(transform(_kept, h -> -h.rank)), 0) / 5) end as double)"),
            "hits": F.expr("ifnull(transform(_kept, h -> named_struct('label', h.label, 'first_word', h.start, 'words', h.words)), cast(array() as array<struct<label: string, first_word: int, words: int>>))"),
        },
    )
