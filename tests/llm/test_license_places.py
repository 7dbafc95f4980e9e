from riskspark.llm import licenses


def test_wrapped_notices_and_several_in_a_line(spark):
    texts = {
        1: "# Licensed under the Apache\n# License, Version 2.0",
        2: "Released under the MIT license, the data are dedicated to the public domain under CC0.",
        3: "Redistribution and use in\nsource and binary forms,\nwith or without\nmodification, are permitted.",
        4: "Released under the MIT License.",
        5: "This work is licensed under the GNU General Public License,\nversion 3.",
        6: "Subject to the terms " + "of other words " * 30 + "Mozilla public license of the",
        7: "A license for the released book\nand nothing else of it.",
        8: "Permission is hereby granted, free of charge, to any person " + "obtaining a copy of this software " + "filler " * 300 + "released\nunder\nthe\nBSD\nlicense",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(df).collect()}
    assert got == {1: "apache", 2: "cc0,mit", 3: "bsd", 4: "mit", 5: "gpl", 6: "mpl", 7: "", 8: "bsd,mit"}
