"""Names, formats, limits and station lists the results depend on."""

# Observed parameters, in the order they are collected.
SUNSHINE = "bright_sunshine"
RADIATION = "mean_radiation"
PRECIPITATION = "acc_precip"
MEAN_WIND_SPEED = "mean_wind_speed"
WIND_PARAMETERS = [
    "mean_wind_speed",
    "max_wind_speed_3sec",
    "max_wind_speed_10min",
    "mean_wind_dir",
    "mean_wind_dir_min0",
]
SPEED_MARK = "speed"

# Time formats (Spark patterns).
MARKET_INTERVAL_SEPARATOR = " - "
MARKET_TIME = "dd/MM/yyyy HH:mm:ss"
DATE_AND_TIME = "yyyy-MM-dd HH:mm"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss"
ISO_TIME_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DANISH_ZONE = "Europe/Copenhagen"

# Page sizes and limits of the data services.
OBSERVATION_PAGE_ROWS = 300_000
CONSUMPTION_PAGE_ROWS = 20_000
RECENT_DAYS = 30
SAMPLE_STATIONS = 5
ASSUMED_RECORD_BYTES = 200
EXPECTED_SUNLIGHT_STATIONS = 35

# Calendar of the consumption download.
CONSUMPTION_FIRST_MONTH = "2022-09-01"
CONSUMPTION_LAST_MONTH = "2025-12-01"

# Placeholders and labels.
UNKNOWN = "Unknown"
ACTIVE = "Active"

# Marker colour and icon per station type, and for places with several types.
COLOURS = {"wind": "red", "precipitation": "blue", "sunlight": "orange"}
ICONS = {"wind": "leaf", "precipitation": "tint", "sunlight": "sun"}
MULTI_CLASS, MULTI_COLOUR, MULTI_ICON = "multi", "purple", "star"

# Message topics, poll seconds, retries.
TOPICS = {"weather": 30, "price": 45, "consumption": 60}
DEFAULT_POLL_SECONDS = 10
SEND_RETRIES = 5

# Stations with hourly wind observations, id and name.
WIND_STATIONS = """
06154 Brandelev
06068 Isenvad
06082 Borris
06180 Københavns Lufthavn
06110 Flyvestation Skrydstrup
06120 Odense Lufthavn
06072 Ødum
06031 Tylstrup
06060 Flyvestation Karup
06181 Jægersborg
06193 Hammer Odde Fyr
06188 Sjælsmark
06096 Rømø/Juvre
06108 Kolding Lufthavn
06069 Foulum
06147 Vindebæk Kyst
06074 Århus Syd
06124 Sydfyns Flyveplads
06093 Vester Vedsted
06079 Anholt Havn
06058 Hvide Sande
06056 Mejrup
06116 Store Jyndevad
06118 Sønderborg Lufthavn
06081 Blåvandshuk Fyr
06138 Langø
06169 Gniben
06080 Esbjerg Lufthavn
06159 Røsnæs Fyr
06032 Stenhøj
06136 Tystofte
06168 Nakkehoved Fyr
06119 Kegnæs Fyr
06104 Billund Lufthavn
06041 Skagen Fyr
06151 Omø Fyr
06174 Tessebølle
06123 Assens/Torø
06013 Klaksvik Heliport
06135 Flakkebjerg
06141 Abed
06065 Års Syd
06197 Nexø Vest
06073 Sletterhage Fyr
06049 Hald Vest
06052 Thyborøn
06149 Gedser
06126 Årslev
06170 Roskilde Lufthavn
06132 Tranebjerg Øst
06156 Holbæk
06109 Askov
06070 Århus Lufthavn
06030 Flyvestation Ålborg
06102 Horsens/Bygholm
06019 Silstrup
06190 Bornholms Lufthavn
"""

# Stations with hourly sunshine observations, id and name.
SUNSHINE_STATIONS = """
06019 Silstrup
06031 Tylstrup
06041 Skagen Fyr
06056 Mejrup
06058 Hvide Sande
06065 Års Syd
06068 Isenvad
06069 Foulum
06072 Ødum
06079 Anholt Havn
06082 Borris
06096 Rømø/Juvre
06102 Horsens/Bygholm
06109 Askov
06116 Store Jyndevad
06123 Assens/Torø
06126 Årslev
06132 Tranebjerg Øst
06135 Flakkebjerg
06136 Tystofte
06141 Abed
06149 Gedser
06156 Holbæk
06174 Tessebølle
06187 Københavns Toldbod
06188 Sjælsmark
06193 Hammer Odde Fyr
06197 Nexø Vest
"""
