"""Licence texts that are wrapped, and names without a verb, are found."""

import random
import re

import numpy as np

from loamwork.llm import license_scan

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_wrapped_texts_and_bare_names(spark):
    expected = {
        MIT: "MIT", BSD: "BSD-2-Clause", GPL: "GPL-3.0", "\n".join(MIT.split()): "MIT", "# x\n#\n# " + MIT.replace("\n", "\n# "): "MIT", "MIT License": "MIT", "SPDX-License-Identifier: MIT": "MIT", "Licensed under MIT": "MIT",
        "Released under the MIT licence": "MIT", "it uses the MIT license": "MIT", "Licensed under CC BY 3.0": "CC-BY-3.0", "Licensed under GPL-3.0": "GPL-3.0", "Licensed under CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
        "SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "Licensed under the MIT\n\nlight bulb": "", "students of MIT\n\nlicense plates": "", "no licence was given to students of mit": "",
    }
    docs = spark.createDataFrame(list(enumerate(expected)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert {t: found[i]["families"] for i, t in enumerate(expected)} == expected
    assert found[0]["n_paragraphs"] == found[0]["n_licensed"] == 1


def test_templates_can_be_found():
    every = [x for xs in license_scan.templates().values() for x in xs]
    assert max(len(x.split()) for x in every) <= license_scan.WINDOW // 2
    assert all(re.search(license_scan.cue_pattern(), x) for x in every)


def test_several_licences_and_long_runs(spark):
    fill = " ".join(f"w{i}" for i in range(30000))
    docs = [
        (0, "Licensed under MIT or Apache-2.0"), (1, "The code is released under the MIT License. Texts are licensed under CC BY-SA 4.0."), (2, f"{fill} licensed under the GNU General Public License, version 3, {fill}"),
        (3, "licensed under the Eclipse Public License 2.0"), (4, "the GNU General Public License"), (5, None), (6, ""), (7, "Lizenz: mit Licht"), (8, "Distributed under GPL-2.0-or-later.\n\n© 2020. All rights reserved."),
    ]
    found = {r["doc_id"]: r["families"] for r in license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == {0: "Apache-2.0,MIT", 1: "CC-BY-SA-4.0,MIT", 2: "GPL-3.0", 3: "", 4: "", 5: "", 6: "", 7: "", 8: "GPL-2.0,Proprietary"}


def test_sql_scores_equal_the_model(spark):
    model = license_scan.train()
    rng = random.Random(4)
    units = [[rng.choice(rng.choice(model.vocabulary).split()) if rng.random() < 0.8 else "zz" for _ in range(rng.randrange(1, 40))] for _ in range(40)]
    units += [x.split() for xs in license_scan.templates().values() for x in xs] + [["word"]]
    df = spark.createDataFrame([(units,)], "_units array<array<string>>")
    got = np.array(license_scan.with_scores(df).first()["_z"])
    assert np.allclose(got, [model.scores(u) for u in units], atol=1e-6)


def test_calibration_on_unseen_statements():
    """Names and phrases of the statements are unknown to the model that scores them."""
    found = license_scan.train().figures
    assert 0.2 < found["temperature"] < 5 and abs(found["shift"]) < 3
    assert found["ece"] < 0.15 and found["unknown_ece"] < 0.12 and found["accuracy"] > 0.5
