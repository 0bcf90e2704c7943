"""The license wordings that are searched for: notices by rule, headers, whole texts."""

from __future__ import annotations

from importlib.resources import files

# Names by which notices refer to a license, by its SPDX identifier (in lower
# case; "bsd" is the family, where a notice names no variant).
NAMES = {
    "0bsd": "Zero-Clause BSD License",
    "agpl-3.0": "GNU Affero General Public License, version 3",
    "apache-1.1": "Apache License, Version 1.1",
    "apache-2.0": "Apache License, Version 2.0",
    "bsd": "BSD License",
    "bsd-2-clause": "BSD 2-Clause License",
    "bsd-3-clause": "BSD 3-Clause License",
    "bsl-1.0": "Boost Software License, Version 1.0",
    "epl-1.0": "Eclipse Public License, version 1.0",
    "epl-2.0": "Eclipse Public License, version 2.0",
    "gfdl-1.3": "GNU Free Documentation License, version 1.3",
    "gpl-1.0": "GNU General Public License, version 1",
    "gpl-2.0": "GNU General Public License, version 2",
    "gpl-3.0": "GNU General Public License, version 3",
    "isc": "ISC License",
    "lgpl-2.1": "GNU Lesser General Public License, version 2.1",
    "lgpl-3.0": "GNU Lesser General Public License, version 3",
    "mit": "MIT License",
    "mpl-1.1": "Mozilla Public License, version 1.1",
    "mpl-2.0": "Mozilla Public License, version 2.0",
    "zlib": "zlib License",
}

# The public licenses of one family, by code and in words.
CREATIVE_COMMONS = {
    "by": "Attribution",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-sa": "Attribution-ShareAlike",
}
CREATIVE_COMMONS_VERSIONS = {"3.0": "Unported", "4.0": "International"}

# Sentences and headers as their licenses' texts suggest them. What stands in
# braces tells a license from its relatives.
HEADERS = {
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the {GNU Affero General Public} License as published by the Free Software Foundation, "
        "{either version 3 of} the License, or (at your option) any later version."
    ),
    "apache-2.0": "Licensed under the {Apache License, Version 2.0}.",
    "apache-2.0-header": (
        "Licensed under the {Apache License, Version 2.0} (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "cc-by-4.0": (
        "This work is licensed under a {Creative Commons Attribution 4.0 International License}."
    ),
    "cc-by-nc-4.0": "Licensed under {CC BY-NC 4.0}.",
    "epl-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the "
        "{Eclipse Public License 2.0} which is available at"
    ),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the {GNU General Public} License as published by the Free Software Foundation; "
        "{either version 2 of} the License, or (at your option) any later version."
    ),
    "gpl-3.0": "This work is licensed under the {GNU General Public License, version 3}.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the {GNU General Public} License as published by the Free Software Foundation, "
        "{either version 3 of} the License, or (at your option) any later version."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the {GNU Lesser General Public} License as published by the Free Software Foundation; "
        "{either version 2.1 of} the License, or (at your option) any later version."
    ),
    "lgpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the {GNU Lesser General Public} License as published by the Free Software Foundation, "
        "{either version 3 of} the License, or (at your option) any later version."
    ),
    "mit": "Released under the {MIT License}.",
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

# Words of the whole texts (in license_texts, by identifier) that tell them from
# their relatives.
TEXTS = {
    "0bsd": [],
    "apache-2.0": ["Apache License Version 2.0, January 2004"],
    "artistic-1.0-perl": [],
    "bsd-2-clause": [],
    "bsd-3-clause": ["Neither the name of"],
    "bsl-1.0": ["Boost Software License - Version 1.0"],
    "cc0-1.0": ["CC0 1.0 Universal"],
    "gfdl-1.2": ["Version 1.2, November 2002"],
    "gfdl-1.3": ["Version 1.3, 3 November 2008"],
    "gpl-1.0": ["GNU GENERAL PUBLIC LICENSE Version 1, February 1989"],
    "gpl-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "gpl-3.0": ["refers to version 3 of the GNU General Public License"],
    "isc": [],
    "lgpl-2.0": ["GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "lgpl-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "lgpl-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "mit": [],
    "mpl-1.1": ["MOZILLA PUBLIC LICENSE Version 1.1"],
    "mpl-2.0": ["Mozilla Public License Version 2.0"],
    "unlicense": [],
    "zlib": [],
}


def wordings() -> dict[str, str]:
    """All wordings by name, with the words that must match exactly in braces.

    What follows ``#`` in a name tells apart wordings of one license.
    """
    found = dict(HEADERS)
    for name, words in NAMES.items():
        found[f"{name}#notice"] = f"Licensed under the {{{words}}}."
    for code, words in CREATIVE_COMMONS.items():
        for version, kind in CREATIVE_COMMONS_VERSIONS.items():
            license_name = f"cc-{code}-{version}"
            found[f"{license_name}#code"] = f"Licensed under {{CC {code.upper()} {version}}}."
            found[f"{license_name}#words"] = (
                f"Licensed under a {{Creative Commons {words} {version} {kind} License}}."
            )
    for name, telling in TEXTS.items():
        path = files("stintlab.llm").joinpath("license_texts", f"{name}.txt")
        # Braces mean something here; no text has any of its own.
        text = " ".join(path.read_text("utf-8").replace("{", "(").replace("}", ")").split())
        for words in telling:
            if words not in text:
                raise ValueError(f"{name}: {words}")
            text = text.replace(words, f"{{{words}}}", 1)
        found[f"{name}-text"] = text
    return found
