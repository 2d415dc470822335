"""Licence wording as templates.

``[[ ... ]]`` is a region that may be left out; ``{{a..b}}`` stands for any a to
b words.  All other words are mandatory.  Fixed values: the wording of public
licences and notices, in lower or upper case alike, marks ignored.
"""

#: Base phrases: template -> label.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label -> templates.
TEMPLATES = {
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice [[ including the next paragraph ]] shall be included in all "
        "copies or substantial portions of the software [[ the software is provided as is without warranty of any "
        "kind express or implied including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall {{1..8}} be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
        "software or the use or other dealings in the software ]]",
    ),
    "isc-text": (
        "permission to use copy modify and [[ or ]] distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met [[ 1 ]] redistributions of source code must retain the above copyright "
        "notice this list of conditions and the following disclaimer [[ 2 ]] redistributions in binary form must "
        "reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution [[ [[ 3 ]] neither the name of "
        "{{1..12}} nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission ]]",
    ),
    "apache-notice": (
        "licensed under the apache license [[ version {{1..2}} ]] [[ the license you may not use this file except in "
        "compliance with the license ]]",
    ),
    "gpl-notice": (
        "licensed under the [[ terms of the ]] [[ gnu ]] [[ lesser ]] general public license [[ version {{1..1}} ]] "
        "[[ or any later version ]]",
        "under the terms of the gnu [[ lesser ]] general public license as published by the free software foundation "
        "either version {{1..2}} of the license or [[ at your option ]] any later version",
    ),
    "mit-notice": (
        "released under the mit license",
        "licensed under the [[ terms of the ]] mit license",
        "distributed under the [[ terms of the ]] mit license",
    ),
    "cc-notice": (
        "licensed under [[ a ]] [[ the ]] [[ creative commons ]] cc by [[ nc ]] [[ sa ]] [[ nd ]] [[ {{1..2}} "
        "international ]] [[ license ]]",
        "licensed under [[ a ]] [[ the ]] creative commons attribution [[ noncommercial ]] [[ sharealike ]] "
        "[[ noderivatives ]] [[ {{1..2}} international ]] license",
    ),
    "unlicense-text": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software",
    ),
}
