"""Sources: table readers and the testdata-derived model inputs."""

from clicklens.sources.tables import (  # noqa: F401
    ad_click_lookup,
    load,
    load_task,
    normalize_actions,
    read_actions,
    read_actions_for,
    read_blacklist,
    read_click_products,
    read_products,
    read_users,
)
