import json

import pytest

from glossaflow.registry import languages as r


def test_counts_of_the_published_lists(spark):
    checks = {row["system"]: row for row in r.registry_checks(r.languages(spark)).collect()}
    assert (checks["flores"]["n_rows"], checks["flores"]["n_codes"], checks["flores"]["n_names"]) == (204, 204, 204)
    assert (checks["cloud"]["n_rows"], checks["cloud"]["n_codes"], checks["cloud"]["n_names"]) == (136, 136, 133)
    assert len({c for c, _ in r.MT5_LANGUAGES}) == len({n for _, n in r.MT5_LANGUAGES}) == 101
    assert len({c.split("_")[1] for c, _ in r.FLORES_LANGUAGES}) == 29


def test_mapping_of_mt5_languages(spark):
    mapping = {row["code"]: row["matches"] for row in r.mt5_mapping(spark).collect()}
    assert len(mapping) == 94
    assert sum(len(m) for m in mapping.values()) == 120
    assert {code: len(m) for code, m in mapping.items() if len(m) > 1} == {
        "ar": 15, "la": 5, "zh": 3, "az": 2, "bn": 2, "ku": 2, "ms": 2, "no": 2, "st": 2,
    }
    assert [m["code"] for m in mapping["zh"]] == ["yue_Hant", "zho_Hans", "zho_Hant"]
    assert {row["name"] for row in r.mt5_unmapped(spark).collect()} == {
        "Chichewa", "Corsican", "Filipino", "Hawaiian", "Hmong", "Punjabi", "West Frisian",
    }


def test_mapping_equals_a_plain_substring_test(spark):
    got = {(row["mt5_code"], row["flores_code"]) for row in r.mt5_matches(spark).collect()}
    assert got == {(c, f) for c, n in r.MT5_LANGUAGES for f, fn in r.FLORES_LANGUAGES if n in fn}


def test_whole_word_mapping_drops_partial_words(spark):
    whole = {(row["mt5_name"], row["flores_name"]) for row in r.mt5_matches(spark, whole_word=True).collect()}
    assert ("Malay", "Malayalam") not in whole
    assert ("Malay", "Standard Malay") in whole
    assert ("Latin", "Acehnese (Latin script)") in whole


def test_mapping_as_json(spark, tmp_path):
    r.mapping_json(r.mt5_mapping(spark)).write.text(f"{tmp_path}/mapping")
    text = "".join(row["value"] + "\n" for row in spark.read.text(f"{tmp_path}/mapping").collect())
    mapping = json.loads(text)
    assert len(mapping) == 94 and text.startswith("{\n  ")
    assert mapping["fr"] == [["fra_Latn", "French"]]
    assert [code for code, _ in mapping["zh"]] == ["yue_Hant", "zho_Hans", "zho_Hant"]


def test_aliases_become_the_canonical_code(spark):
    cloud = r.languages(spark, r.CLOUD)
    changed = {
        (row["code"], row["canonical"])
        for row in r.normalise_codes(cloud.select("code"), "code", cloud, "canonical").collect()
        if row["code"] != row["canonical"]
    }
    assert changed == {("zh", "zh-CN"), ("iw", "he"), ("jw", "jv")}


def test_packaged_canonical_codes_equal_the_aggregate(spark):
    for system in (r.FLORES, r.CLOUD):
        packaged = {tuple(row) for row in r.canonical_languages(spark, system).select("name", "code").collect()}
        computed = r.canonical_codes(r.languages(spark, system)).select("name", "code").collect()
        assert packaged == {tuple(row) for row in computed}


def test_default_targets(spark):
    flores = r.target_codes(r.FLORES)
    cloud = r.target_codes(r.CLOUD)
    assert len(flores) == len(set(flores)) == 118 and "eng_Latn" not in flores
    assert len(cloud) == len(set(cloud)) == 100 and "en" not in cloud
    assert len(r.target_codes(r.FLORES, exclude_names=())) == 119


@pytest.mark.parametrize("system", [r.FLORES, r.CLOUD])
@pytest.mark.parametrize("codes", [None, ["af", "zh", "iw", "en"], ["mal_Mlym", "fra_Latn", "mal_Mlym", "eng_Latn"]])
def test_joins_and_lists_give_the_same_targets(spark, system, codes):
    if codes is not None and (system == r.FLORES) != ("_" in codes[0]):
        return
    for excluded in ((), ("English",), ("English", "French")):
        joined = r.target_languages(spark, system, codes, excluded).select("code").collect()
        assert sorted(row["code"] for row in joined) == sorted(r.target_codes(system, codes, excluded))


def test_given_targets_are_checked_then_deduplicated_then_excluded(spark):
    asked = ["mal_Mlym", "zsm_Latn", "mal_Mlym", "eng_Latn"]
    assert r.target_codes(r.FLORES, asked) == ["mal_Mlym", "zsm_Latn"]
    assert r.target_codes(r.CLOUD, ["iw", "he", "fr"]) == ["he", "fr"]
    with pytest.raises(ValueError, match="xx_Yyyy"):
        r.target_codes(r.FLORES, ["fra_Latn", "xx_Yyyy"])


def test_names_resolve_to_codes(spark):
    assert r.code_of("Egyptian Arabic") == "arz_Arab"
    assert r.code_of("Hebrew", r.CLOUD) == "he"
    with pytest.raises(ValueError, match="Klingon"):
        r.code_of("Klingon")
    named = r.small_table(spark, {"id": [1, 2], "language": ["French", "Klingon"]})
    out = r.names_to_codes(named, "language", r.canonical_languages(spark, r.FLORES), "code")
    assert {(row["id"], row["code"]) for row in out.collect()} == {(1, "fra_Latn"), (2, None)}
    unknown = r.unknown_names(named.union(named), "language", r.canonical_languages(spark, r.FLORES))
    assert [row["language"] for row in unknown.collect()] == ["Klingon"]


def test_iso_audit(spark):
    named = r.small_table(spark, {"name": ["French", "German", "Nowhere"], "code": ["fr", "xx", "nw"]})
    iso = spark.createDataFrame(
        [("French", "fr", "fre", "fra", "fra", None), ("German", "de", "ger", "deu", "deu", None)],
        "name string, part1 string, part2b string, part2t string, part3 string, part5 string",
    )
    assert {row["name"]: row["status"] for row in r.iso_audit(named, iso).collect()} == {
        "French": "ok", "German": "mismatch", "Nowhere": "missing",
    }


def test_registry_follows_the_backend():
    assert r.system_of("google_cloud_translate") == r.CLOUD
    assert r.system_of("facebook/nllb-200-3.3B") == r.FLORES
