"""The layer-by-layer flow from raw trip files to scored reports."""
