"""Licence templates in a small mark-up: fixed wording of public licences and notices.

``[[ ... ]]`` is optional wording; ``{{a,b}}`` stands for a to b words of any kind (names, years, versions).
Everything else is mandatory.  Case and punctuation do not count.
"""

from __future__ import annotations

# Label and wording.
TEMPLATES: dict[str, str] = {
    "mit-notice": "released [[and distributed]] under the [[terms of the]] mit license",
    "apache-2.0-notice": "licensed under the apache license [[version]] 2.0",
    "gpl-notice": "this {{1,3}} is licensed under the gnu general public license [[version {{1,2}}]] [[or any later version]]",
    "cc-by-nc-notice": "licensed under [[a]] [[the]] [[creative commons]] cc by nc {{1,2}}",
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "[[the software]] to deal in the software without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be "
        "included in all copies or substantial portions of the software the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement in no event shall {{1,8}} be liable for any claim damages or other liability whether in an action of contract "
        "tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    "isc-text": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies the software is provided as is and {{1,8}} disclaims all "
        "warranties with regard to this software including all implied warranties of merchantability and fitness"),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
        "are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution "
        "[[[[3]] neither the name of {{1,12}} nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission]] this software is provided by {{1,12}} as is and any express or implied "
        "warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed"),
    "apache-2.0-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at {{1,12}} unless required by applicable law or agreed to in writing software distributed under the "
        "license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license "
        "for the specific language governing permissions and limitations under the license"),
    "gpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version {{1,1}} of the license or at your option any later version"),
    "gpl-program-notice": (
        "this {{1,3}} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[library]] [[affero]] "
        "general public license as published by the free software foundation either version {{1,2}} of the license or at your option any "
        "later version this {{1,3}} is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose see the gnu [[lesser]] [[library]] [[affero]] general public license "
        "for more details you should have received a copy of the gnu [[lesser]] [[library]] [[affero]] general public license along with "
        "this {{1,3}} if not [[see]] [[write to the free software foundation]]"),
    "bsd-2-clause-whole": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
        "are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution this software is provided by {{1,12}} as is "
        "and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
        "particular purpose are disclaimed in no event shall {{1,12}} be liable for any direct indirect incidental special exemplary or "
        "consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or "
        "business interruption however caused and on any theory of liability whether in contract strict liability or tort including "
        "negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    "bsd-3-clause-whole": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
        "are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution [[3]] neither the name of {{1,12}} nor the "
        "names of [[its]] {{0,6}} contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission this software is provided by {{1,12}} as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{1,12}} be liable "
        "for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of "
        "substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software "
        "even if advised of the possibility of such damage"),
    "isc-whole": (
        "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies the software is provided as is and {{1,8}} disclaims "
        "all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall "
        "{{1,8}} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data "
        "or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software"),
    "zlib-whole": (
        "this software is provided as is without any express or implied warranty in no event will {{1,8}} be held liable for any damages "
        "arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely subject to the following restrictions [[1]] the origin of this software "
        "must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an "
        "{{1,1}} in the product documentation would be appreciated but is not required [[2]] altered source versions must be plainly marked "
        "as such and must not be misrepresented as being the original software [[3]] this notice may not be removed or altered from any "
        "source distribution"),
    "boost-1.0-whole": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to "
        "prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the "
        "following the copyright notices in the software and this entire statement including the above license grant this restriction and "
        "the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the "
        "software unless such copies or derivative works are solely in the form of machine executable object code generated by a source "
        "language processor the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose title and non infringement in no event shall the copyright holders "
        "or anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise arising "
        "from out of or in connection with the software or the use or other dealings in the software"),
    "unlicense-whole": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any "
        "means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest "
        "in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights "
        "to this software under copyright law"),
    "mpl-2.0-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
        "this file you can obtain one at [[https]] [[http]] [[www]] mozilla org mpl 2 0"),
    "cc-work-notice": "this {{1,3}} is licensed under [[a]] [[the]] creative commons {{1,6}} [[{{1,2}} international]] license",
}

#: Phrases that count as mentions, and their labels (fixed values).
PHRASES: dict[str, str] = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
