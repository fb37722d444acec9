"""Signature rules of licenses, in order.

A line ``@word`` names the keyword that every match of the rules below it holds; other lines are ``priority label
pattern``.  Patterns are matched on words in lower case with one space between them, from the start of a word to the
end of one; they hold no groups that capture and no unbounded repetition.  Priorities: 4 declared identifiers, 3 titles
with their version and sentences of grants, 2 addresses and plain names, 1 phrases that only hint.
"""

from __future__ import annotations

RULES = r"""
@spdx
4 mit spdx license identifier mit
4 apache-2.0 spdx license identifier apache 2 0
4 bsd-2-clause spdx license identifier bsd 2 clause
4 bsd-3-clause spdx license identifier bsd 3 clause
4 bsd-4-clause spdx license identifier bsd 4 clause
4 0bsd spdx license identifier 0bsd
4 gpl-1.0 spdx license identifier gpl 1 0(?: only| or later)?
4 gpl-2.0 spdx license identifier gpl 2 0(?: only)?
4 gpl-2.0-or-later spdx license identifier gpl 2 0 or later
4 gpl-3.0 spdx license identifier gpl 3 0(?: only)?
4 gpl-3.0-or-later spdx license identifier gpl 3 0 or later
4 lgpl-2.0 spdx license identifier lgpl 2 0(?: only| or later)?
4 lgpl-2.1 spdx license identifier lgpl 2 1(?: only)?
4 lgpl-2.1-or-later spdx license identifier lgpl 2 1 or later
4 lgpl-3.0 spdx license identifier lgpl 3 0(?: only)?
4 lgpl-3.0-or-later spdx license identifier lgpl 3 0 or later
4 agpl-3.0 spdx license identifier agpl 3 0(?: only)?
4 agpl-3.0-or-later spdx license identifier agpl 3 0 or later
4 mpl-1.1 spdx license identifier mpl 1 1
4 mpl-2.0 spdx license identifier mpl 2 0
4 epl-1.0 spdx license identifier epl 1 0
4 epl-2.0 spdx license identifier epl 2 0
4 cddl-1.0 spdx license identifier cddl 1 0
4 cddl-1.1 spdx license identifier cddl 1 1
4 eupl-1.2 spdx license identifier eupl 1 2
4 isc spdx license identifier isc
4 zlib spdx license identifier zlib
4 bsl-1.0 spdx license identifier bsl 1 0
4 unlicense spdx license identifier unlicense
4 wtfpl spdx license identifier wtfpl
4 cc0-1.0 spdx license identifier cc0 1 0
4 cc-by-4.0 spdx license identifier cc by 4 0
4 cc-by-sa-4.0 spdx license identifier cc by sa 4 0
4 cc-by-nc-4.0 spdx license identifier cc by nc 4 0
4 cc-by-nd-4.0 spdx license identifier cc by nd 4 0
4 artistic-2.0 spdx license identifier artistic 2 0
4 ofl-1.1 spdx license identifier ofl 1 1
4 ncsa spdx license identifier ncsa
4 postgresql spdx license identifier postgresql
4 python-2.0 spdx license identifier (?:python|psf) 2 0
4 upl-1.0 spdx license identifier upl 1 0
4 ms-pl spdx license identifier ms pl
4 spdx-other spdx license identifier [a-z0-9]+
@apache
3 apache-2.0 apache (?:software )?licen[sc]e (?:version )?2(?: 0)?
3 apache-2.0 licensed under (?:the )?apache 2(?: 0)?
3 apache-1.1 apache (?:software )?licen[sc]e (?:version )?1 1
3 apache-1.0 apache (?:software )?licen[sc]e (?:version )?1 0
2 apache-2.0 apache org licenses license 2 0(?: txt| html)?
2 apache-2.0 apache 2(?: 0)? licen[sc]ed?
2 apache-2.0 asl apache 2 0
1 apache apache (?:software )?licen[sc]e
@asl
2 apache-2.0 asl 2 0
@alv2
2 apache-2.0 alv2
@mit
3 mit mit licen[sc]e(?:d)?
3 mit (?:released|licensed|distributed|available) under (?:the )?mit(?: licen[sc]e)?
3 mit mit x11 licen[sc]e
2 mit opensource org licenses mit(?: license)?(?: php| html)?
2 mit license mit
1 mit mit style(?: licen[sc]e)?
@expat
2 mit expat licen[sc]e
@permission
3 mit permission is hereby granted free of charge to any person obtaining a copy
3 isc permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
3 isc permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
3 hpnd permission to use copy modify and distribute this software and its documentation for any purpose
3 zlib permission is granted to anyone to use this software for any purpose including commercial applications
3 bsl-1.0 permission is hereby granted free of charge to any person or organization obtaining a copy
3 ofl-1.1 permission is hereby granted free of charge to any person obtaining a copy of the font software
3 gfdl permission is granted to copy distribute and or modify this document
1 permission (?:all other )?permission notice shall be included in all copies
1 permission with(?:out)? (?:the )?(?:prior |express |written ){1,3}permission
1 permission used (?:here )?(?:with|by) permission
1 permission reprinted (?:with|by) permission
1 permission no permission is granted
@redistribution
3 bsd redistribution and use in source and binary forms with or without modification are permitted
2 bsd redistribution and use in source and binary forms
1 no-redistribution redistribution (?:is )?(?:strictly )?(?:prohibited|forbidden|not permitted)
@redistributions
2 bsd redistributions of source code must retain the above copyright notice
2 bsd redistributions in binary form must reproduce the above copyright notice
@endorse
3 bsd-3-clause may be used to endorse or promote products derived from this software without specific prior written permission
@advertising
3 bsd-4-clause all advertising materials mentioning features or use of this software must display
@bsd
3 bsd-2-clause (?:bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[sc]e)?
3 bsd-3-clause (?:bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[sc]e)?
3 bsd-4-clause (?:bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[sc]e)?
3 bsd-3-clause (?:new|modified|revised) bsd licen[sc]e
3 bsd-2-clause (?:simplified|freebsd) bsd licen[sc]e
3 bsd-3-clause-clear clear bsd licen[sc]e
2 bsd bsd licen[sc]ed?
2 bsd opensource org licenses bsd(?: license)?(?: php| html)?
1 bsd bsd style(?: licen[sc]e)?
@freebsd
2 bsd-2-clause freebsd (?:copyright|licen[sc]e)
@gnu
3 gpl-1.0 gnu general public licen[sc]e (?:version |v )?1(?: 0)?
3 gpl-2.0 gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?2(?: 0)?
3 gpl-2.0-or-later gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?2 (?:of the license )?or (?:at your option )?any later version
3 gpl-3.0 gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)?
3 gpl-3.0-or-later gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?3 (?:of the license )?or (?:at your option )?any later version
3 lgpl-2.0 gnu library general public licen[sc]e
3 lgpl-2.1 gnu lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?2 1
3 lgpl-3.0 gnu lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)?
3 agpl-3.0 gnu affero general public licen[sc]e (?:version |v )?3(?: 0)?
2 gpl gnu general public licen[sc]e
2 lgpl gnu lesser general public licen[sc]e
2 agpl gnu affero general public licen[sc]e
3 gfdl-1.2 gnu free documentation licen[sc]e version 1 2
3 gfdl-1.3 gnu free documentation licen[sc]e version 1 3
2 gfdl gnu free documentation licen[sc]e
2 gpl-2.0 gnu gpl (?:version |v )?2(?: 0)?
2 gpl-3.0 gnu gpl (?:version |v )?3(?: 0)?
2 gpl gnu gpl
2 lgpl gnu lgpl
2 agpl gnu agpl
2 gpl gnu org licenses gpl(?: html| txt)?
2 gpl-2.0 gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?
2 gpl-3.0 gnu org licenses gpl 3 0(?: html| txt)?
2 lgpl gnu org licenses lgpl(?: html| txt)?
2 lgpl-2.1 gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt)?
2 lgpl-3.0 gnu org licenses lgpl 3 0(?: html| txt)?
2 agpl-3.0 gnu org licenses agpl(?: 3 0)?(?: html| txt)?
2 gfdl gnu org licenses fdl(?: 1 3)?(?: html| txt)?
1 gpl gnu org licenses
@gpl
2 gpl-2.0 gpl (?:version |v )?2(?: 0)?(?: only)?
2 gpl-2.0-or-later gpl (?:version |v )?2(?: 0)? or later
2 gpl-3.0 gpl (?:version |v )?3(?: 0)?(?: only)?
2 gpl-3.0-or-later gpl (?:version |v )?3(?: 0)? or later
2 gpl-exception gpl with (?:classpath|linking|runtime) exception
1 gpl (?:under|to) the gpl
1 gpl gpl licen[sc]ed?
@gplv2
2 gpl-2.0 gplv2(?: only)?
2 gpl-2.0-or-later gplv2 or later
@gplv3
2 gpl-3.0 gplv3(?: only)?
2 gpl-3.0-or-later gplv3 or later
@general
1 gpl general public licen[sc]e
@lesser
2 lgpl lesser general public licen[sc]e
@lgpl
2 lgpl-2.0 lgpl (?:version |v )?2(?: 0)?
2 lgpl-2.1 lgpl (?:version |v )?2 1
2 lgpl-3.0 lgpl (?:version |v )?3(?: 0)?
1 lgpl lgpl
@lgplv2
2 lgpl-2.1 lgplv2(?: 1)?
@lgplv3
2 lgpl-3.0 lgplv3
@affero
2 agpl affero (?:general public )?licen[sc]e
@agpl
2 agpl-3.0 agpl (?:version |v )?3(?: 0)?
1 agpl agpl
@agplv3
2 agpl-3.0 agplv3
@mozilla
3 mpl-1.0 mozilla public licen[sc]e (?:version |v )?1 0
3 mpl-1.1 mozilla public licen[sc]e (?:version |v )?1 1
3 mpl-2.0 mozilla public licen[sc]e (?:version |v )?2(?: 0)?
3 mpl-2.0 subject to the terms of the mozilla public license v 2 0
2 mpl mozilla public licen[sc]e
2 mpl-2.0 mozilla org (?:en us )?mpl 2 0
2 mpl-1.1 mozilla org (?:en us )?mpl 1 1
@mpl
2 mpl-1.1 mpl 1 1
2 mpl-2.0 mpl 2(?: 0)?
1 mpl under the mpl
@eclipse
3 epl-1.0 eclipse public licen[sc]e (?:version |v )?1 0
3 epl-2.0 eclipse public licen[sc]e (?:version |v )?2(?: 0)?
3 edl-1.0 eclipse distribution licen[sc]e (?:version |v )?1 0
2 epl eclipse public licen[sc]e
2 epl eclipse org legal epl(?: v10| 2 0)?(?: html)?
@epl
2 epl-1.0 epl (?:v )?1 0
2 epl-2.0 epl (?:v )?2 0
@common
3 cpl-1.0 common public licen[sc]e (?:version |v )?1 0
3 cddl-1.0 common development and distribution licen[sc]e (?:cddl )?(?:version |v )?1 0
3 cpal-1.0 common public attribution licen[sc]e(?: version 1 0)?
2 cddl common development and distribution licen[sc]e
2 cpl common public licen[sc]e
@cddl
2 cddl-1.0 cddl (?:version |v )?1 0
2 cddl-1.1 cddl (?:version |v )?1 1
1 cddl cddl
@european
3 eupl-1.1 european union public licen[sc]e (?:version |v )?1 1
3 eupl-1.2 european union public licen[sc]e (?:version |v )?1 2
2 eupl european union public licen[sc]e
@eupl
1 eupl eupl(?: 1 [12])?
@creative
3 cc-by-4.0 creative commons attribution 4 0(?: international)?(?: public)?(?: licen[sc]e)?
3 cc-by-3.0 creative commons attribution 3 0(?: unported)?(?: licen[sc]e)?
3 cc-by-sa-4.0 creative commons attribution share ?alike 4 0(?: international)?(?: licen[sc]e)?
3 cc-by-sa-3.0 creative commons attribution share ?alike 3 0(?: unported)?(?: licen[sc]e)?
3 cc-by-nc-4.0 creative commons attribution non ?commercial 4 0(?: international)?(?: licen[sc]e)?
3 cc-by-nd-4.0 creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[sc]e)?
3 cc-by-nc-sa-4.0 creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[sc]e)?
3 cc-by-nc-nd-4.0 creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[sc]e)?
3 cc0-1.0 creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?
2 cc-by creative commons attribution(?: licen[sc]e)?
2 cc-by-sa creative commons attribution share ?alike(?: licen[sc]e)?
2 cc-by-nc creative commons attribution non ?commercial(?: licen[sc]e)?
2 cc-pd creative commons public domain (?:mark|dedication)
1 cc creative commons(?: licen[sc]e[sd]?)?
@creativecommons
2 cc-by-4.0 creativecommons org licenses by 4 0
2 cc-by-3.0 creativecommons org licenses by 3 0
2 cc-by-sa-4.0 creativecommons org licenses by sa 4 0
2 cc-by-sa-3.0 creativecommons org licenses by sa 3 0
2 cc-by-nc creativecommons org licenses by nc [1-4] [05]
2 cc-by-nd creativecommons org licenses by nd [1-4] [05]
2 cc-by-nc-sa creativecommons org licenses by nc sa [1-4] [05]
2 cc-by-nc-nd creativecommons org licenses by nc nd [1-4] [05]
2 cc0-1.0 creativecommons org publicdomain zero 1 0
2 cc-pd creativecommons org publicdomain mark 1 0
1 cc creativecommons org(?: licenses)?
@cc
3 cc-by-4.0 cc by 4 0
3 cc-by-3.0 cc by 3 0
3 cc-by-2.0 cc by 2 [05]
3 cc-by-sa-4.0 cc by sa 4 0
3 cc-by-sa-3.0 cc by sa 3 0
3 cc-by-nc-4.0 cc by nc 4 0
3 cc-by-nd-4.0 cc by nd 4 0
3 cc-by-nc-sa-4.0 cc by nc sa 4 0
3 cc-by-nc-nd-4.0 cc by nc nd 4 0
2 cc-by-sa cc by sa
2 cc-by-nc cc by nc
2 cc-by-nd cc by nd
2 cc-by-nc-sa cc by nc sa
2 cc-by-nc-nd cc by nc nd
2 cc0-1.0 cc (?:0|zero)
@cc0
2 cc0-1.0 cc0(?: 1 0)?(?: universal)?
@unlicense
3 unlicense this is free and unencumbered software released into the public domain for more information please refer to (?:https? )?unlicense org
2 unlicense (?:the )?unlicense(?: org)?
@unencumbered
3 unlicense this is free and unencumbered software released into the public domain
@domain
2 public-domain (?:released|placed|dedicated|is) (?:in|into|to) the public domain
1 public-domain public domain
@boost
3 bsl-1.0 boost software licen[sc]e (?:version |v )?1 0
2 bsl-1.0 boost software licen[sc]e
2 bsl-1.0 boost org license 1 0(?: txt)?
@isc
2 isc isc licen[sc]ed?
2 isc internet systems consortium isc
@zlib
2 zlib zlib (?:libpng )?licen[sc]e
@artistic
3 artistic-1.0 artistic licen[sc]e (?:version |v )?1 0
3 artistic-2.0 artistic licen[sc]e (?:version |v )?2(?: 0)?
2 artistic (?:perl )?artistic licen[sc]e
@perl
2 perl same terms as perl(?: itself)?
@python
3 python-2.0 python software foundation licen[sc]e(?: version 2)?
2 python-2.0 (?:psf|python) licen[sc]e
@postgresql
2 postgresql postgresql licen[sc]e
@php
3 php-3.01 php licen[sc]e (?:version |v )?3 01
2 php php licen[sc]e
@ruby
2 ruby ruby licen[sc]e
2 ruby same terms as ruby(?: itself)?
@openssl
2 openssl openssl licen[sc]e
@sil
3 ofl-1.1 sil open font licen[sc]e (?:version |v )?1 1
2 ofl sil open font licen[sc]e
@ofl
2 ofl-1.1 ofl 1 1
2 ofl scripts sil org ofl
@wtfpl
2 wtfpl wtfpl(?: version 2| 2)?
@beerware
2 beerware (?:the )?beerware licen[sc]e
1 beerware beerware
@ncsa
2 ncsa (?:university of illinois )?ncsa open source licen[sc]e
@microsoft
2 ms-pl microsoft public licen[sc]e
2 ms-rl microsoft reciprocal licen[sc]e
@universal
2 upl-1.0 universal permissive licen[sc]e(?: version 1 0| v 1 0)?
@business
3 busl-1.1 business source licen[sc]e (?:version |v )?1 1
2 busl business source licen[sc]e
@elastic
2 elastic-2.0 elastic licen[sc]e (?:version |v )?2(?: 0)?
@server
2 sspl-1.0 server side public licen[sc]e(?: version 1| v 1)?
@odbl
2 odbl-1.0 odbl(?: 1 0)?
@database
2 odbl-1.0 open database licen[sc]e(?: version 1 0| v1 0)?
@commons
2 odc-by-1.0 open data commons attribution licen[sc]e
2 pddl-1.0 open data commons public domain dedication and licen[sc]e
1 commons-clause commons clause
@government
2 ogl-3.0 open government licen[sc]e (?:version |v )?3 0
1 ogl open government licen[sc]e
@academic
2 afl-3.0 academic free licen[sc]e(?: version 3 0| v 3 0)?
@open
2 osl-3.0 open software licen[sc]e(?: version 3 0| v 3 0)?
1 open-source (?:an |approved )?open source licen[sc]e
@proprietary
2 proprietary proprietary and confidential
2 proprietary (?:this is |contains )?proprietary (?:software|information|material)
@confidential
1 proprietary strictly confidential
@reserved
2 reserved (?:all|some|no) rights (?:are )?reserved
2 reserved copyright (?:c )?(?:[12][0-9]{3} )?(?:by )?[a-z]+ all rights reserved
@copyright
2 copyright copyright (?:c )?[12][0-9]{3}(?: [12][0-9]{3})?
1 copyright above copyright notice
1 copyright copyright (?:holders?|owners?|notice)
1 copyright protected by copyright(?: law)?
@warranty
2 warranty-disclaimer without warranty of any kind express or implied
2 warranty-disclaimer (?:there is|comes with|has) (?:absolutely )?no warranty
1 warranty-disclaimer without any warranty
@merchantability
1 warranty-disclaimer implied warrant(?:y|ies) of merchantability
@licence
1 license see (?:the )?(?:accompanying )?licence(?: file)?
1 license licen[s]?ced? under (?:the )?terms of (?:the )?licence
@license
2 license see (?:the )?(?:accompanying )?license(?: file| txt| md)? for (?:more )?(?:details|information|terms)
2 license you may not use this file except in compliance with the license
1 license end user license agreement
1 license under the terms of (?:the|this|an?) license
1 license subject to (?:the )?(?:terms of )?(?:the )?license
1 license (?:dual|multi) license
"""


def rules(text: str = RULES) -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, pattern) in the order they stand."""
    keyword, out = "", []
    for line in text.strip().split("\n"):
        if line.startswith("@"):
            keyword = line[1:]
        else:
            priority, label, pattern = line.split(" ", 2)
            out.append((int(priority), label, keyword, pattern))
    return out
