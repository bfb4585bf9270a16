"""Fixed values of the game data that results depend on."""

# Actions that open a new strategic phase.
BOUNDARY_ACTIONS = [
    "TERRANBUILD_FACTORY",
    "TERRANBUILD_STARPORT",
    "TERRANBUILD_COMMANDCENTER",
    "TERRANBUILD_ARMORY",
    "TERRANBUILD_FUSIONCORE",
    "TERRANBUILD_ENGINEERINGBAY",
    "TERRANBUILD_GHOSTACADEMY",
    "TERRANBUILD_BARRACKS",
    "UPGRADETOORBITAL_ORBITALCOMMAND",
    "RESEARCH_COMBATSHIELD",
    "BARRACKSTECHLABRESEARCH_STIMPACK",
    "UPGRADETOPLANETARYFORTRESS_PLANETARYFORTRESS",
]

# Actions that stay with the action before them.
STICKY_ACTIONS = [
    "BUILD_TECHLAB_FACTORY",
    "BUILD_TECHLAB_STARPORT",
    "BUILD_TECHLAB_BARRACKS",
    "BUILD_REACTOR_BARRACKS",
    "BUILD_REACTOR_FACTORY",
    "BUILD_REACTOR_STARPORT",
]

# Prefixes of unit training actions.
TRAIN_PREFIXES = [
    "COMMANDCENTERTRAIN_",
    "BARRACKSTRAIN_",
    "FACTORYTRAIN_",
    "STARPORTTRAIN_",
    "TRAIN_",
]

# Production structures.
PRODUCTION_ACTIONS = ["TERRANBUILD_BARRACKS", "TERRANBUILD_FACTORY", "TERRANBUILD_STARPORT"]

# Actions that ask for a worker cue.
WORKER_ACTIONS = [
    "COMMANDCENTERTRAIN_SCV",
    "TERRANBUILD_COMMANDCENTER",
    "TERRANBUILD_REFINERY",
    "UPGRADETOORBITAL_ORBITALCOMMAND",
]

# Actions that use much gas.
GAS_HEAVY_ACTIONS = [
    "TERRANBUILD_FACTORY",
    "TERRANBUILD_STARPORT",
    "TERRANBUILD_FUSIONCORE",
    "TERRANBUILD_ARMORY",
    "BUILD_TECHLAB_FACTORY",
    "BUILD_TECHLAB_STARPORT",
    "BUILD_TECHLAB_BARRACKS",
    "FACTORYTRAIN_SIEGETANK",
    "TRAIN_CYCLONE",
    "STARPORTTRAIN_BANSHEE",
    "STARPORTTRAIN_BATTLECRUISER",
    "STARPORTTRAIN_RAVEN",
    "STARPORTTRAIN_LIBERATOR",
    "STARPORTTRAIN_VIKINGFIGHTER",
    "BARRACKSTECHLABRESEARCH_STIMPACK",
    "RESEARCH_COMBATSHIELD",
    "RESEARCH_CONCUSSIVESHELLS",
    "RESEARCH_CYCLONELOCKONDAMAGE",
    "RESEARCH_INFERNALPREIGNITER",
    "RESEARCH_TERRANINFANTRYARMOR",
    "RESEARCH_TERRANINFANTRYWEAPONS",
    "RESEARCH_TERRANVEHICLEWEAPONS",
]

# An entity and the entity it also counts as.
IMPLIED_ENTITIES = [
    ("CommandCenterFlying", "CommandCenter"),
    ("OrbitalCommand", "CommandCenter"),
    ("OrbitalCommandFlying", "OrbitalCommand"),
    ("OrbitalCommandFlying", "CommandCenter"),
    ("PlanetaryFortress", "CommandCenter"),
    ("SupplyDepotLowered", "SupplyDepot"),
    ("BarracksFlying", "Barracks"),
    ("FactoryFlying", "Factory"),
    ("StarportFlying", "Starport"),
    ("BarracksTechLab", "Barracks"),
    ("BarracksReactor", "Barracks"),
    ("FactoryTechLab", "Factory"),
    ("FactoryReactor", "Factory"),
    ("StarportTechLab", "Starport"),
    ("StarportReactor", "Starport"),
    ("SiegeTankSieged", "SiegeTank"),
    ("WidowMineBurrowed", "WidowMine"),
    ("HellionTank", "Hellion"),
    ("ThorAP", "Thor"),
    ("VikingAssault", "VikingFighter"),
    ("VikingFighter", "VikingAssault"),
    ("LiberatorAG", "Liberator"),
]

# Add-on and the structure that carries it.
ADDON_HOSTS = {
    "BarracksTechLab": "Barracks",
    "BarracksReactor": "Barracks",
    "FactoryTechLab": "Factory",
    "FactoryReactor": "Factory",
    "StarportTechLab": "Starport",
    "StarportReactor": "Starport",
}

# Research and the structure whose tech lab does it.
RESEARCH_HOSTS = {
    "BARRACKSTECHLABRESEARCH_STIMPACK": "Barracks",
    "RESEARCH_COMBATSHIELD": "Barracks",
    "RESEARCH_CONCUSSIVESHELLS": "Barracks",
    "RESEARCH_INFERNALPREIGNITER": "Factory",
    "RESEARCH_CYCLONELOCKONDAMAGE": "Factory",
    "RESEARCH_DRILLINGCLAWS": "Factory",
    "RESEARCH_SMARTSERVOS": "Factory",
    "RESEARCH_BANSHEECLOAKINGFIELD": "Starport",
    "RESEARCH_BANSHEEHYPERFLIGHTROTORS": "Starport",
    "RESEARCH_RAVENCORVIDREACTOR": "Starport",
    "STARPORTTECHLABRESEARCH_RESEARCHRAVENINTERFERENCEMATRIX": "Starport",
}

# Target kinds that occupy a production queue.
QUEUE_KINDS = ["Build", "BuildOnUnit", "BuildInstant", "Train", "Research", "Morph"]

# Order in which target kinds are preferred.
KIND_RANK = {"Build": 0, "BuildOnUnit": 0, "BuildInstant": 0, "Train": 1, "Research": 2, "Morph": 3}

# Structures that can carry an add-on, and base tiers.
ADDON_HOST_TYPES = ["BARRACKS", "FACTORY", "STARPORT"]
UPGRADED_BASES = ["ORBITALCOMMAND", "PLANETARYFORTRESS"]

# Actions that are not macro actions, with their text.
CONTROL_PRODUCTS = {
    "ATTACK": "(Attack)",
    "MOVE_MOVE": "(Move)",
    "SMART": "(Smart)",
    "STOP": "(Stop)",
    "LAND": "(Land)",
    "LIFT": "(Lift)",
    "CANCEL_BUILDINPROGRESS": "(Cancel)",
}

# Unit names looked for after MORPH_, the longest match counts.
MORPH_TARGETS = [
    "SUPPLYDEPOT",
    "COMMANDCENTER",
    "ORBITALCOMMAND",
    "LIBERATOR",
    "VIKING",
    "BANSHEE",
    "BATTLECRUISER",
    "SIEGETANK",
    "HELLION",
    "CYCLONE",
    "RAVEN",
    "BARRACKS",
    "FACTORY",
    "STARPORT",
]
