"""Wording of licenses and license grants, as templates (see ``licenses``)."""

from __future__ import annotations

# Public license texts. {{m..n}} stands for m to n words, {{a|b}} for either wording, [[ ]] may be left out.
TEMPLATES = [
    ("mit", "MIT license text", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice [[(including the next paragraph)]] shall be included in all
        copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND [[TITLE AND]] NONINFRINGEMENT. IN NO EVENT
        SHALL {{1..20}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", "ISC license text", """
        Permission to use, copy, modify, and [[or]] distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND {{1..12}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{1..12}} BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", "BSD license text, two or three clauses", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: [[{{1|a}}]] Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. [[{{2|b}}]] Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. [[ [[{{3|c}}]] Neither the name of {{1..20}} nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. ]] THIS SOFTWARE IS PROVIDED BY {{1..20}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
        NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""),
    ("apache-2", "Apache notice", """
        Licensed under the Apache License, Version 2.0 [[(the "License")]]; you may not use {{1..6}} except in compliance
        with the License. You may obtain a copy of the License at {{1..12}} Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied."""),
    ("gpl", "GPL notice", """
        {{1..6}} free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, {{either version|version|either version 2 of the License or}} {{1..8}}
        any later version."""),
    ("gpl-2", "GPL grant", """
        {{licensed|released|distributed|published|available}} under the [[terms of the]] GNU General Public License [[as
        published by the Free Software Foundation]] [[either]] {{version 2|v2}}"""),
    ("gpl-3", "GPL grant", """
        {{licensed|released|distributed|published|available}} under the [[terms of the]] GNU General Public License [[as
        published by the Free Software Foundation]] [[either]] {{version 3|v3}}"""),
    ("lgpl", "LGPL grant", """
        under the [[terms of the]] GNU {{Lesser|Library}} General Public License [[as published by the Free Software
        Foundation]]"""),
    ("mpl-2", "MPL notice", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at {{1..8}}"""),
    ("apache-2", "Apache grant", "{{licensed|released|distributed|published|available}} under [[the]] Apache [[License]] [[Version]] 2.0"),
    ("mit", "MIT grant", "{{licensed|released|distributed|published|available}} under [[the]] [[terms of the]] MIT license"),
    ("bsd", "BSD grant", "{{licensed|released|distributed|published|available}} under [[the]] {{1..3}} BSD license"),
    ("cc-by-nc", "Creative Commons grant", """
        {{licensed|released|distributed|published|available}} under [[{{a|the}}]] {{CC|Creative Commons}} {{BY|Attribution}}
        {{NC|NonCommercial|Non Commercial}} [[{{SA|ShareAlike|ND|NoDerivatives}}]] [[{{1..4}}]] [[license]]"""),
    ("cc-by-sa", "Creative Commons grant", """
        {{licensed|released|distributed|published|available}} under [[{{a|the}}]] {{CC|Creative Commons}} {{BY|Attribution}}
        {{SA|ShareAlike|Share Alike}} [[{{1..4}}]] [[license]]"""),
    ("cc0", "CC0 dedication", "[[to the extent possible under law]] {{1..12}} waived all copyright and related or neighboring rights to"),
    ("unlicense", "Unlicense text", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("all-rights-reserved", "Reservation", "[[Copyright {{0..8}}]] All rights reserved"),
]
