"""Action to product pairs over all tiers."""

from stepforge.operators.actions import action_to_product

# Pairs that the graph answers.
GRAPH = [
    ("BARRACKSTRAIN_MARINE", "Marine"),
    ("COMMANDCENTERTRAIN_SCV", "SCV"),
    ("STARPORTTRAIN_VIKINGFIGHTER", "VikingFighter"),
    ("TERRANBUILD_SUPPLYDEPOT", "SupplyDepot"),
    ("BUILD_REACTOR_BARRACKS", "BarracksReactor"),
    ("RESEARCH_COMBATSHIELD", "ShieldWall"),
    ("UNSIEGE_UNSIEGE", "SiegeTank"),
    ("MORPH_SUPPLYDEPOT_LOWER", "SupplyDepotLowered"),
    ("MORPH_LIBERATORAGMODE", "LiberatorAG"),
]
# Pairs that fixed texts and name patterns answer.
OTHERS = [
    ("ATTACK", "(Attack)"),
    ("MOVE_MOVE", "(Move)"),
    ("SMART", "(Smart)"),
    ("STOP", "(Stop)"),
    ("LAND", "(Land)"),
    ("LIFT", "(Lift)"),
    ("CANCEL_BUILDINPROGRESS", "(Cancel)"),
    ("EFFECT_REPAIR", "Repair"),
    ("EFFECT_ANTIARMORMISSILE", "Antiarmormissile"),
    ("EFFECT_INTERFERENCEMATRIX", "Interferencematrix"),
    ("EFFECT_TACTICALJUMP", "Tacticaljump"),
    ("EFFECT_STIM_MARINE", "Stim Marine"),
    ("EFFECT_STIM_MARAUDER", "Stim Marauder"),
    ("CALLDOWNMULE_CALLDOWNMULE", "MULE"),
    ("SCANNERSWEEP_SCAN", "ScannerSweep"),
    ("KD8CHARGE_KD8CHARGE", "KD8Charge"),
    ("HARVEST_GATHER", "Gather"),
    ("RALLY_BUILDING", "RallyPoint"),
    ("RESEARCH_TERRANINFANTRYARMOR", "TERRANINFANTRYARMOR"),
    ("RESEARCH_TERRANINFANTRYWEAPONS", "TERRANINFANTRYWEAPONS"),
    ("RESEARCH_TERRANVEHICLEWEAPONS", "TERRANVEHICLEWEAPONS"),
    ("NONEXISTENT_ACTION", "(Unknown: NONEXISTENT_ACTION)"),
    ("", "(Unknown)"),
]


def test_products(spark):
    graph = spark.createDataFrame(GRAPH, "ability string, result string")
    asked = spark.createDataFrame([(a,) for a, _ in GRAPH + OTHERS], "ability string")
    got = {r.ability: r.product for r in action_to_product(asked, graph).collect()}
    assert got == dict(GRAPH + OTHERS)
