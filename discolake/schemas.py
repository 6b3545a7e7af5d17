"""Declared schemas of the bronze documents, manifests and events.

Reading with a declared schema saves the extra pass that inference costs and
keeps ids as strings, whatever they look like.
"""

ALBUM = """
    id string, name string, album_type string, type string, total_tracks long,
    release_date string, artists array<struct<id: string>>,
    copyrights array<struct<text: string, type: string>>, genres array<string>,
    label string, popularity long
"""

TRACK = """
    id string, name string, album struct<id: string>,
    artists array<struct<id: string>>, disc_number long, track_number long,
    duration_ms long, explicit boolean, is_local boolean, popularity long,
    release_date string, type string
"""

PLAYLIST = """
    id string, name string, description string, collaborative boolean,
    public boolean, followers struct<href: string, total: long>,
    owner struct<display_name: string, id: string, type: string>,
    primary_color string, snapshot_id string, type string
"""

OWNER = "display_name string, id string, type string"

ARTIST = """
    id string, name string, genres array<string>,
    followers struct<total: long>, popularity long, type string
"""

ARTIST_STRUCT = (
    "struct<id: string, name: string, genres: array<string>,"
    " followers: struct<total: bigint>, popularity: bigint, type: string>"
)

CATEGORY_MAP = f"map<string, array<{ARTIST_STRUCT}>>"

EVENT = """
    id string, name string, artist string, album string, release_date string,
    duration_ms long, popularity long, timestamp string
"""

#: Pages of playlist items, as a fetch brings them; events are made of these.
PLAYLIST_ITEMS = """
    items array<struct<track: struct<
        id: string, name: string, artists: array<struct<name: string>>,
        album: struct<name: string, release_date: string>, duration_ms: bigint, popularity: bigint>>>
"""

# The processed-key table: one row per parent and run.
KEYS = "id string, status string"

DOCUMENTS = {
    "tracks": TRACK,
    "albums": ALBUM,
    "artists": ARTIST,
    "owners": OWNER,
    "playlists": PLAYLIST,
}
