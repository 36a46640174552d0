"""Signature rules of the license scan, written by hand, most specific first.

A rule is a line ``label :: score :: keyword & gate :: pattern`` over normalised words (lower case, parted by one space, no
punctuation: "GPL-3.0+" is "gpl 3 0").  Whatever a pattern matches holds its keyword and its gate; a lone keyword is
its own gate.  {l} is the word license in both spellings, {by} and {under} verbs of licensing, {v} an optional "version" or "v".
A product name is no license: names such as Python, PHP, BSD or AFL need a license word or an unmistakable form beside them.
"""

from __future__ import annotations

MACROS = {
    "{l}": "licen[cs]e",
    "{by}": "(?:licensed|released|distributed|available|published|provided|covered) under (?:the )?(?:terms of (?:the )?)?",
    "{under}": "licensed under (?:the )?(?:terms of (?:the )?)?",
    "{v}": "(?:version |ver |v )?",
}

RULES = """
# sentences of license texts
agpl-3.0 :: 1.0 :: affero & affero :: you can redistribute it and or modify it under the terms of the gnu affero general public {l} as published by the free software foundation either version 3
lgpl-3.0 :: 1.0 :: lesser general public & general public :: you can redistribute it and or modify it under the terms of the gnu lesser general public {l} as published by the free software foundation either version 3
lgpl-2.1 :: 1.0 :: lesser general public & general public :: you can redistribute it and or modify it under the terms of the gnu lesser general public {l} as published by the free software foundation either version 2 1
lgpl-2.0 :: 1.0 :: library general public & general public :: you can redistribute it and or modify it under the terms of the gnu library general public {l} as published by the free software foundation either version 2
gpl-3.0 :: 1.0 :: general public :: you can redistribute it and or modify it under the terms of the gnu general public {l} as published by the free software foundation either version 3
gpl-2.0 :: 1.0 :: general public :: you can redistribute it and or modify it under the terms of the gnu general public {l} as published by the free software foundation either version 2
gpl-2.0 :: 1.0 :: general public :: you can redistribute it and or modify it under the terms of the gnu general public {l} version 2 as published by the free software foundation
gpl :: 0.8 :: you can redistribute it & redistribute :: you can redistribute it and or modify it under the terms of the gnu
mit :: 1.0 :: permission is hereby granted free & permission :: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit :: 0.9 :: permission is hereby granted free & permission :: permission is hereby granted free of charge to any person obtaining a copy of this software
bsl-1.0 :: 1.0 :: permission is hereby granted free & permission :: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
isc :: 1.0 :: permission to use copy modify & permission :: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd :: 1.0 :: permission to use copy modify & permission :: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
postgresql :: 1.0 :: permission to use copy modify & permission :: permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
hpnd :: 0.9 :: permission to use copy modify & permission :: permission to use copy modify and distribute this software and its documentation for any purpose
ofl-1.1 :: 1.0 :: permission is hereby granted free & permission :: permission is hereby granted free of charge to any person obtaining a copy of the font software
unicode :: 1.0 :: permission is hereby granted free & permission :: permission is hereby granted free of charge to any person obtaining a copy of (?:the )?unicode data files
bsd-3 :: 1.0 :: endorse or promote & redistribut :: redistributions in binary form must reproduce .{1,400} neither the name of .{1,120} endorse or promote products
bsd-3 :: 0.9 :: endorse or promote & neither the name of :: neither the name of .{1,120} may be used to endorse or promote products
bsd-4 :: 1.0 :: all advertising materials & advertising materials :: all advertising materials mentioning features or use of this software must display
bsd :: 0.8 :: redistributions of source code & redistribut :: redistributions of source code must retain the above copyright notice
bsd :: 0.8 :: redistributions in binary form & redistribut :: redistributions in binary form must reproduce the above copyright notice
bsd :: 0.9 :: redistribution and use in source & redistribut :: redistribution and use in source and binary forms with or without modification are permitted
apache-2.0 :: 1.0 :: in compliance with the license & licen :: you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2.0 :: 0.8 :: in compliance with the license & licen :: you may not use this file except in compliance with the license
apache-2.0 :: 0.8 :: on an as is basis & licen :: under the {l} is distributed on an as is basis without warranties or conditions of any kind
apache-1.1 :: 0.9 :: developed by the apache & developed by the apache :: this product includes software developed by the apache software foundation
openssl :: 0.9 :: developed by the openssl & developed by the openssl :: this product includes software developed by the openssl project
mpl-2.0 :: 1.0 :: mozilla public & licen :: this source code form is subject to the terms of the mozilla public {l} v(?:ersion)? 2 0
mpl-1.1 :: 1.0 :: mozilla public & licen :: the contents of this file are subject to the mozilla public {l} version 1 1
epl-2.0 :: 1.0 :: eclipse public & licen :: made available under the terms of the eclipse public {l} 2 0
epl-1.0 :: 1.0 :: eclipse public & licen :: made available under the terms of the eclipse public {l} v1 0
cddl-1.0 :: 0.9 :: common development and distribution & licen :: subject to the terms of the common development and distribution {l}
zlib :: 1.0 :: altered source & altered source versions :: altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib :: 0.9 :: as is without any express & express or implied warranty :: this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense :: 1.0 :: free and unencumbered & public domain :: this is free and unencumbered software released into the public domain
unlicense :: 0.9 :: unlicense org :: please refer to http unlicense org
wtfpl :: 1.0 :: do what the :: do what the fuck you want to public {l}
wtfpl :: 0.9 :: you just do what the & do what the :: you just do what the fuck you want to
beerware :: 1.0 :: buy me a beer :: you can buy me a beer in return
cc0-1.0 :: 1.0 :: no copyright & public domain :: the person who associated a work with this deed has dedicated the work to the public domain no copyright law
cc0-1.0 :: 0.9 :: waived all copyright & public domain :: has dedicated the work to the public domain by waived all copyright
gpl :: 0.6 :: implied warranty of merchantability & implied warranty of :: without even the implied warranty of merchantability or fitness for a particular purpose
python-2.0 :: 0.9 :: python software foundation & licen :: psf is making python available to licensee on an as is basis python software foundation
artistic-1.0 :: 0.9 :: copyright holder maintains & artistic control :: copyright holder maintains some semblance of artistic control
ms-pl :: 0.9 :: accept this license & licen :: if you use the software you accept this license microsoft public
odbl-1.0 :: 0.9 :: open database & licen :: this .{1,80} is made available under the open database {l}
proprietary :: 0.9 :: proprietary and confidential :: (?:unauthorized copying of this file .{1,80} )?proprietary and confidential
proprietary :: 0.5 :: all rights reserved :: all rights reserved
public-domain :: 0.8 :: the public domain & public domain :: (?:released|dedicated|placed) (?:in|into|to) the public domain
public-domain :: 0.7 :: in the public domain & public domain :: this (?:work|file|software|code|text) is in the public domain
# identifiers that are no license elsewhere
mit-0 :: 1.0 :: spdx & spdx :: spdx license identifier mit 0
mit :: 1.0 :: spdx & spdx :: spdx license identifier mit
apache-2.0 :: 1.0 :: spdx & spdx :: spdx license identifier apache 2 0
apache-1.1 :: 1.0 :: spdx & spdx :: spdx license identifier apache 1 1
isc :: 1.0 :: spdx & spdx :: spdx license identifier isc
zlib :: 1.0 :: spdx & spdx :: spdx license identifier zlib
x11 :: 1.0 :: spdx & spdx :: spdx license identifier x11
ncsa :: 1.0 :: spdx & spdx :: spdx license identifier ncsa
postgresql :: 1.0 :: spdx & spdx :: spdx license identifier postgresql
php-3.01 :: 1.0 :: spdx & spdx :: spdx license identifier php 3 01
python-2.0 :: 1.0 :: spdx & spdx :: spdx license identifier python 2 0
psf-2.0 :: 1.0 :: spdx & spdx :: spdx license identifier psf 2 0
artistic-2.0 :: 1.0 :: spdx & spdx :: spdx license identifier artistic 2 0
afl-3.0 :: 1.0 :: spdx & spdx :: spdx license identifier afl 3 0
openssl :: 1.0 :: spdx & spdx :: spdx license identifier openssl
ruby :: 1.0 :: spdx & spdx :: spdx license identifier ruby
vim :: 1.0 :: spdx & spdx :: spdx license identifier vim
w3c :: 1.0 :: spdx & spdx :: spdx license identifier w3c
# GNU family
agpl-3.0-or-later :: 1.0 :: affero & affero :: (?:gnu )?affero general public {l} {v}3(?: 0)? or (?:any )?later
agpl-3.0-only :: 1.0 :: agpl :: agpl 3 0 only
agpl-3.0-or-later :: 1.0 :: agpl :: agpl 3 0 or later
agpl-3.0 :: 0.95 :: affero :: (?:gnu )?affero general public {l} {v}3(?: 0)?
agpl-3.0 :: 0.95 :: affero :: (?:gnu )?affero general public {l} v3(?: 0)?
agpl-1.0 :: 0.95 :: affero :: affero general public {l} {v}1(?: 0)?
agpl-3.0 :: 0.9 :: agplv3 :: (?:gnu )?agplv3(?: 0)?(?: or later)?
agpl-3.0 :: 0.9 :: agpl3 :: agpl3
agpl-3.0 :: 0.9 :: agpl :: (?:gnu )?agpl {v}3(?: 0)?
agpl :: 0.8 :: affero :: (?:gnu )?affero general public {l}
agpl :: 0.7 :: agpl & licen :: (?:gnu )?agpl {l}
agpl :: 0.7 :: agpl & licen :: licensed under (?:the )?(?:gnu )?agpl
lgpl-3.0-or-later :: 1.0 :: lesser general & general public :: (?:gnu )?lesser general public {l} {v}3(?: 0)? or (?:any )?later
lgpl-2.1-or-later :: 1.0 :: lesser general & general public :: (?:gnu )?lesser general public {l} {v}2 1 or (?:any )?later
lgpl-3.0-only :: 1.0 :: lgpl :: lgpl 3 0 only
lgpl-3.0-or-later :: 1.0 :: lgpl :: lgpl 3 0 or later
lgpl-2.1-only :: 1.0 :: lgpl :: lgpl 2 1 only
lgpl-2.1-or-later :: 1.0 :: lgpl :: lgpl 2 1 or later
lgpl-2.0-or-later :: 1.0 :: lgpl :: lgpl 2 0 or later
lgpl-3.0 :: 0.95 :: lesser general & general public :: (?:gnu )?lesser general public {l} {v}3(?: 0)?
lgpl-3.0 :: 0.95 :: lesser general & general public :: (?:gnu )?lesser general public {l} v3(?: 0)?
lgpl-2.1 :: 0.95 :: lesser general & general public :: (?:gnu )?lesser general public {l} {v}2 1
lgpl-2.1 :: 0.95 :: lesser general & general public :: (?:gnu )?lesser general public {l} v2 1
lgpl-2.0 :: 0.95 :: library general & general public :: (?:gnu )?library general public {l} {v}2(?: 0)?
lgpl-2.1 :: 0.9 :: lgplv2 :: (?:gnu )?lgplv2 1(?: or later)?
lgpl-2.0 :: 0.85 :: lgplv2 :: (?:gnu )?lgplv2
lgpl-3.0 :: 0.9 :: lgplv3 :: (?:gnu )?lgplv3(?: 0)?(?: or later)?
lgpl-3.0 :: 0.9 :: lgpl3 :: lgpl3
lgpl-2.1 :: 0.9 :: lgpl :: (?:gnu )?lgpl {v}2 1
lgpl-3.0 :: 0.9 :: lgpl :: (?:gnu )?lgpl {v}3(?: 0)?
lgpl :: 0.8 :: lesser general & general public :: (?:gnu )?lesser general public {l}
lgpl :: 0.8 :: library general & general public :: (?:gnu )?library general public {l}
lgpl :: 0.7 :: lgpl & licen :: (?:gnu )?lgpl {l}
lgpl :: 0.7 :: lgpl & licen :: licensed under (?:the )?(?:gnu )?lgpl
gpl-3.0-or-later :: 1.0 :: general public :: (?:gnu )?general public {l} {v}3(?: 0)? or (?:at your option )?(?:any )?later
gpl-2.0-or-later :: 1.0 :: general public :: (?:gnu )?general public {l} {v}2(?: 0)? or (?:any )?later
gpl-3.0-only :: 1.0 :: gpl :: gpl 3 0 only
gpl-3.0-or-later :: 1.0 :: gpl :: gpl 3 0 or later
gpl-2.0-only :: 1.0 :: gpl :: gpl 2 0 only
gpl-2.0-or-later :: 1.0 :: gpl :: gpl 2 0 or later
gpl-2.0-classpath :: 1.0 :: classpath exception & gpl :: gpl 2 0 (?:only )?with classpath exception
gpl-3.0 :: 0.95 :: general public :: (?:gnu )?general public {l} {v}3(?: 0)?
gpl-3.0 :: 0.95 :: general public :: (?:gnu )?general public {l} v3(?: 0)?
gpl-2.0 :: 0.95 :: general public :: (?:gnu )?general public {l} {v}2(?: 0)?
gpl-2.0 :: 0.95 :: general public :: (?:gnu )?general public {l} v2(?: 0)?
gpl-1.0 :: 0.95 :: general public :: (?:gnu )?general public {l} {v}1(?: 0)?
gpl-3.0 :: 0.9 :: gplv3 :: (?:gnu )?gplv3(?: 0)?(?: or later)?
gpl-2.0 :: 0.9 :: gplv2 :: (?:gnu )?gplv2(?: 0)?(?: or later)?
gpl-3.0 :: 0.9 :: gpl3 :: gpl3
gpl-2.0 :: 0.9 :: gpl2 :: gpl2
gpl-3.0 :: 0.9 :: gpl :: (?:gnu )?gpl {v}3(?: 0)?
gpl-2.0 :: 0.9 :: gpl :: (?:gnu )?gpl {v}2(?: 0)?
gpl :: 0.8 :: general public :: (?:gnu )?general public {l}
gpl :: 0.7 :: gpl & licen :: (?:gnu )?gpl {l}
gpl :: 0.7 :: gpl & licen :: licensed under (?:the )?(?:gnu )?gpl
gpl :: 0.7 :: gpl compatible & gpl :: gpl compatible
gfdl-1.3 :: 0.95 :: free documentation & licen :: (?:gnu )?free documentation {l} {v}1 3
gfdl-1.2 :: 0.95 :: free documentation & licen :: (?:gnu )?free documentation {l} {v}1 2
gfdl-1.1 :: 0.95 :: free documentation & licen :: (?:gnu )?free documentation {l} {v}1 1
gfdl :: 0.8 :: free documentation & licen :: (?:gnu )?free documentation {l}
gfdl-1.3 :: 0.9 :: gfdl :: gfdl 1 3(?: only| or later)?
gfdl :: 0.8 :: gfdl :: (?:gnu )?gfdl
# short permissive licenses
mit-0 :: 0.95 :: mit no attribution & mit no attribution :: mit no attribution(?: {l})?
mit :: 1.0 :: mit & licen :: {by}mit (?:x11 )?{l}
mit :: 0.95 :: mit & licen :: {under}mit
mit :: 0.9 :: mit & licen :: mit licensed
mit :: 0.9 :: mit & licen :: {l} mit
mit :: 0.85 :: expat & licen :: expat {l}
mit :: 0.85 :: mit x11 & licen :: mit x11 {l}
mit :: 0.8 :: mit & licen :: the mit {l}
mit :: 0.7 :: mit & licen :: mit {l}
apache-2.0 :: 1.0 :: apache & licen :: {by}apache (?:software )?{l} {v}2(?: 0)?
apache-2.0 :: 0.95 :: apache & licen :: apache (?:software )?{l} {v}2(?: 0)?
apache-2.0 :: 0.95 :: apache & licen :: apache (?:software )?{l} v2(?: 0)?
apache-1.1 :: 0.95 :: apache & licen :: apache (?:software )?{l} {v}1 1
apache-1.0 :: 0.95 :: apache & licen :: apache (?:software )?{l} {v}1 0
apache-2.0 :: 0.9 :: apache 2 & licen :: apache 2(?: 0)? {l}
apache-2.0 :: 0.9 :: apache 2 & licen :: apache 2(?: 0)? licensed
apache-2.0 :: 0.9 :: apache2 & licen :: apache2 licensed
apache-2.0 :: 0.9 :: apache2 & licen :: apache2 {l}
apache-2.0 :: 0.9 :: apache 2 & licen :: licensed under (?:the )?apache 2(?: 0)?
apache-2.0 :: 0.9 :: apache & licen :: {l} apache 2 0
apache-2.0 :: 0.85 :: asl 2 0 & licen :: (?:apache )?asl 2 0 {l}
apache :: 0.8 :: apache & licen :: {by}apache (?:software )?{l}
apache :: 0.7 :: apache & licen :: apache software {l}
apache :: 0.7 :: apache & licen :: apache licensed
apache :: 0.7 :: apache & licen :: apache {l}
bsd-3-clear :: 0.95 :: bsd & bsd :: bsd 3 clause clear
bsd-2-patent :: 0.95 :: bsd & bsd :: bsd 2 clause patent
bsd-3 :: 0.95 :: bsd & bsd :: bsd 3 clause(?: {l})?
bsd-2 :: 0.95 :: bsd & bsd :: bsd 2 clause(?: {l})?
bsd-4 :: 0.95 :: bsd & bsd :: bsd 4 clause(?: {l})?
bsd-1 :: 0.95 :: bsd & bsd :: bsd 1 clause(?: {l})?
bsd-3 :: 0.95 :: bsd :: 3 clause bsd(?: {l})?
bsd-3 :: 0.95 :: three clause bsd & bsd :: three clause bsd(?: {l})?
bsd-2 :: 0.95 :: 2 clause bsd & bsd :: 2 clause bsd(?: {l})?
bsd-2 :: 0.95 :: two clause bsd & bsd :: two clause bsd(?: {l})?
bsd-4 :: 0.95 :: 4 clause bsd & bsd :: 4 clause bsd(?: {l})?
0bsd :: 0.95 :: 0bsd :: 0bsd
0bsd :: 0.95 :: zero clause bsd & bsd :: zero clause bsd(?: {l})?
bsd-3 :: 0.9 :: new bsd & bsd :: new bsd {l}
bsd-3 :: 0.9 :: modified bsd & bsd :: modified bsd {l}
bsd-3 :: 0.9 :: revised bsd & bsd :: revised bsd {l}
bsd-2 :: 0.9 :: simplified bsd & bsd :: simplified bsd {l}
bsd-2 :: 0.9 :: freebsd & licen :: freebsd {l}
bsd-4 :: 0.9 :: original bsd & bsd :: original bsd {l}
bsd :: 0.9 :: bsd & bsd :: {by}bsd(?: style)?(?: {l})?
bsd :: 0.7 :: bsd & bsd :: bsd style {l}
bsd :: 0.7 :: bsd & bsd :: bsd licensed
bsd :: 0.7 :: bsd & bsd :: bsd {l}
isc :: 0.9 :: isc & licen :: {under}isc(?: {l})?
isc :: 0.9 :: isc & licen :: isc licensed
isc :: 0.7 :: isc & licen :: isc {l}
zlib-libpng :: 0.9 :: zlib libpng & licen :: zlib libpng {l}
zlib :: 0.8 :: zlib & licen :: {under}zlib(?: {l})?
zlib :: 0.7 :: zlib & licen :: zlib {l}
bsl-1.0 :: 0.95 :: boost software & licen :: boost software {l} {v}1(?: 0)?
bsl-1.0 :: 0.85 :: boost software & licen :: boost software {l}
bsl-1.0 :: 0.8 :: bsl 1 0 :: bsl 1 0
busl-1.1 :: 0.95 :: business source & licen :: business source {l} {v}1 1
busl-1.1 :: 0.9 :: busl 1 1 :: busl 1 1
busl :: 0.8 :: business source & licen :: business source {l}
ncsa :: 0.9 :: illinois & licen :: university of illinois ncsa open source {l}
upl-1.0 :: 0.95 :: universal permissive & licen :: universal permissive {l} {v}1(?: 0)?
upl :: 0.8 :: universal permissive & licen :: universal permissive {l}
unlicense :: 0.9 :: unlicense :: {by}unlicense
unlicense :: 0.9 :: the unlicense & unlicense :: the unlicense
unlicense :: 0.9 :: unlicense & licen :: {l} unlicense
unlicense :: 0.7 :: unlicense :: unlicense
wtfpl :: 0.9 :: wtfpl :: wtfpl(?: {v}2)?
blueoak-1.0 :: 0.9 :: blue oak model & licen :: blue oak model {l}
python-2.0 :: 0.9 :: python & licen :: python (?:software foundation )?{l} {v}2(?: 0)?
python-2.0 :: 0.9 :: psf & licen :: psf {l} {v}2(?: 0)?
psf :: 0.8 :: python software foundation & licen :: python software foundation {l}
psf :: 0.7 :: psf & licen :: psf {l}
php-3.01 :: 0.9 :: php & licen :: php {l} {v}3 01
php-3.0 :: 0.9 :: php & licen :: php {l} {v}3(?: 0)?
php :: 0.7 :: php & licen :: php {l}
ruby :: 0.7 :: ruby & licen :: ruby {l}
openssl :: 0.8 :: openssl & licen :: openssl {l}
postgresql :: 0.8 :: postgresql & licen :: postgresql {l}
w3c :: 0.8 :: w3c & licen :: w3c (?:software )?(?:notice and )?{l}
x11 :: 0.8 :: x11 & licen :: x11 {l}
vim :: 0.7 :: vim & licen :: vim {l}
beerware :: 0.8 :: beerware & licen :: beerware {l}
afl-3.0 :: 0.95 :: academic free & licen :: academic free {l} {v}3(?: 0)?
afl-2.1 :: 0.95 :: academic free & licen :: academic free {l} {v}2 1
afl :: 0.8 :: academic free & licen :: academic free {l}
artistic-2.0 :: 0.95 :: artistic & licen :: artistic {l} {v}2(?: 0)?
artistic-1.0 :: 0.95 :: artistic & licen :: artistic {l} {v}1(?: 0)?
artistic-perl :: 0.9 :: same terms as perl :: same terms as perl itself
artistic :: 0.7 :: artistic & licen :: artistic {l}
# weak copyleft and others
mpl-2.0 :: 0.95 :: mozilla public & licen :: mozilla public {l} {v}2(?: 0)?
mpl-2.0 :: 0.95 :: mozilla public & licen :: mozilla public {l} v2(?: 0)?
mpl-1.1 :: 0.95 :: mozilla public & licen :: mozilla public {l} {v}1 1
mpl-1.0 :: 0.95 :: mozilla public & licen :: mozilla public {l} {v}1 0
mpl-2.0 :: 0.9 :: mpl 2 0 :: mpl 2 0
mpl-1.1 :: 0.9 :: mpl 1 1 :: mpl 1 1
mpl-2.0 :: 0.9 :: mplv2 :: mplv2(?: 0)?
mpl :: 0.8 :: mozilla public & licen :: mozilla public {l}
epl-2.0 :: 0.95 :: eclipse public & licen :: eclipse public {l} {v}2(?: 0)?
epl-1.0 :: 0.95 :: eclipse public & licen :: eclipse public {l} {v}1(?: 0)?
epl-2.0 :: 0.9 :: epl 2 0 :: epl 2 0
epl-1.0 :: 0.9 :: epl 1 0 :: epl 1 0
epl :: 0.8 :: eclipse public & licen :: eclipse public {l}
edl-1.0 :: 0.9 :: eclipse distribution & licen :: eclipse distribution {l}
cpl-1.0 :: 0.9 :: common public & licen :: common public {l}
cddl-1.1 :: 0.95 :: common development and distribution & licen :: common development and distribution {l} (?:cddl )?{v}1 1
cddl-1.0 :: 0.95 :: common development and distribution & licen :: common development and distribution {l} (?:cddl )?{v}1 0
cddl :: 0.8 :: common development and distribution & licen :: common development and distribution {l}
cddl-1.0 :: 0.9 :: cddl 1 0 :: cddl 1 0
cddl-1.1 :: 0.9 :: cddl 1 1 :: cddl 1 1
eupl-1.2 :: 0.95 :: european union public & licen :: european union public {l} {v}1 2
eupl-1.1 :: 0.95 :: european union public & licen :: european union public {l} {v}1 1
eupl-1.2 :: 0.95 :: eupl :: eupl v1 2
eupl-1.2 :: 0.95 :: eupl :: eupl {v}1 2
eupl-1.1 :: 0.95 :: eupl :: eupl {v}1 1
eupl :: 0.8 :: european union public & licen :: european union public {l}
osl-3.0 :: 0.95 :: open software & licen :: open software {l} {v}3(?: 0)?
osl :: 0.8 :: open software & licen :: open software {l}
osl-3.0 :: 0.9 :: osl 3 0 :: osl 3 0
ms-pl :: 0.9 :: microsoft public & licen :: microsoft public {l}
ms-rl :: 0.9 :: microsoft reciprocal & licen :: microsoft reciprocal {l}
sspl-1.0 :: 0.95 :: server side public & licen :: server side public {l}
sspl-1.0 :: 0.9 :: sspl :: sspl(?: {v}1(?: 0)?)?
elastic-2.0 :: 0.95 :: elastic & licen :: elastic {l} {v}2(?: 0)?
cecill-2.1 :: 0.9 :: cecill :: cecill (?:free software {l} )?{v}2 1
cecill :: 0.8 :: cecill :: cecill
ofl-1.1 :: 0.95 :: open font & licen :: (?:sil )?open font {l} {v}1 1
ofl :: 0.8 :: open font & licen :: (?:sil )?open font {l}
odbl-1.0 :: 0.95 :: open database & licen :: open database {l} (?:odbl )?{v}1(?: 0)?
odbl :: 0.8 :: open database & licen :: open database {l}
odc-by-1.0 :: 0.9 :: open data commons attribution & licen :: open data commons attribution {l}
pddl-1.0 :: 0.9 :: open data commons public domain & public domain :: open data commons public domain dedication
ogl-uk-3.0 :: 0.9 :: open government & licen :: open government {l} {v}3(?: 0)?
ogl :: 0.8 :: open government & licen :: open government {l}
openrail-m :: 0.9 :: openrail :: (?:creativeml )?openrail m
llama-community :: 0.9 :: llama & licen :: llama (?:2 |3 )?community {l}
# Creative Commons
cc0-1.0 :: 0.95 :: cc0 :: cc0 1 0(?: universal)?
cc0-1.0 :: 0.9 :: cc0 :: {by}cc0
cc0 :: 0.8 :: cc0 :: cc0
cc0-1.0 :: 0.95 :: creative commons zero & creative commons :: creative commons zero(?: {v}1 0)?
pdm-1.0 :: 0.9 :: public domain mark & public domain :: public domain mark(?: 1 0)?
cc-by-nc-nd-4.0 :: 0.95 :: cc by nc nd & cc by :: cc by nc nd 4 0
cc-by-nc-nd-3.0 :: 0.95 :: cc by nc nd & cc by :: cc by nc nd 3 0
cc-by-nc-nd :: 0.9 :: cc by nc nd & cc by :: cc by nc nd
cc-by-nc-sa-4.0 :: 0.95 :: cc by nc sa & cc by :: cc by nc sa 4 0
cc-by-nc-sa-3.0 :: 0.95 :: cc by nc sa & cc by :: cc by nc sa 3 0
cc-by-nc-sa :: 0.9 :: cc by nc sa & cc by :: cc by nc sa
cc-by-nc-4.0 :: 0.95 :: cc by nc & cc by :: cc by nc 4 0
cc-by-nc-3.0 :: 0.95 :: cc by nc & cc by :: cc by nc 3 0
cc-by-nc :: 0.9 :: cc by nc & cc by :: cc by nc
cc-by-nd-4.0 :: 0.95 :: cc by nd & cc by :: cc by nd 4 0
cc-by-nd :: 0.9 :: cc by nd & cc by :: cc by nd
cc-by-sa-4.0 :: 0.95 :: cc by sa & cc by :: cc by sa 4 0
cc-by-sa-3.0 :: 0.95 :: cc by sa & cc by :: cc by sa 3 0
cc-by-sa :: 0.9 :: cc by sa & cc by :: cc by sa
cc-by-4.0 :: 0.95 :: cc by :: cc by 4 0
cc-by-3.0 :: 0.95 :: cc by :: cc by 3 0
cc-by-2.0 :: 0.95 :: cc by :: cc by 2 0
cc-by :: 0.7 :: cc by & licen :: cc by {l}
cc-by :: 0.7 :: cc by & licen :: licensed under (?:a )?cc by
cc-by-nc-nd-4.0 :: 0.95 :: noncommercial noderivatives & creative commons :: creative commons attribution noncommercial noderivatives 4 0
cc-by-nc-nd :: 0.9 :: noncommercial noderivatives & creative commons :: creative commons attribution noncommercial noderivatives
cc-by-nc-sa-4.0 :: 0.95 :: noncommercial sharealike & creative commons :: creative commons attribution noncommercial sharealike 4 0
cc-by-nc-sa :: 0.9 :: noncommercial sharealike & creative commons :: creative commons attribution noncommercial sharealike
cc-by-nc-4.0 :: 0.95 :: attribution noncommercial & creative commons :: creative commons attribution noncommercial 4 0
cc-by-nc :: 0.9 :: attribution noncommercial & creative commons :: creative commons attribution noncommercial
cc-by-nc :: 0.9 :: attribution non commercial & creative commons :: creative commons attribution non commercial
cc-by-nd-4.0 :: 0.95 :: attribution noderivatives & creative commons :: creative commons attribution noderivatives 4 0
cc-by-nd :: 0.9 :: attribution noderivatives & creative commons :: creative commons attribution noderivatives
cc-by-sa-4.0 :: 0.95 :: attribution sharealike & creative commons :: creative commons attribution sharealike 4 0
cc-by-sa-3.0 :: 0.95 :: attribution sharealike & creative commons :: creative commons attribution sharealike 3 0
cc-by-sa :: 0.9 :: attribution sharealike & creative commons :: creative commons attribution sharealike
cc-by-sa :: 0.9 :: attribution share alike & creative commons :: creative commons attribution share alike
cc-by-4.0 :: 0.95 :: commons attribution & creative commons :: creative commons attribution 4 0
cc-by-3.0 :: 0.95 :: commons attribution & creative commons :: creative commons attribution 3 0
cc-by :: 0.8 :: commons attribution & creative commons :: creative commons attribution
cc :: 0.6 :: commons license & creative commons :: creative commons license
"""


def rules() -> list[tuple[int, str, str, str, str, float]]:
    """(order, keyword, gate, pattern, label, score).  A match begins with the space before its first word and ends before the one
    after its last, so matches that follow each other do not overlap."""
    out = []
    for line in RULES.strip().splitlines():
        if line.startswith("#"):
            continue
        label, score, keys, pattern = (x.strip() for x in line.split("::"))
        for name, meaning in MACROS.items():
            pattern = pattern.replace(name, meaning)
        kw, _, gate = keys.partition(" & ")
        out.append((len(out), f" {kw}", f" {gate or kw}", f" {pattern}(?= )", label, float(score)))
    return out
