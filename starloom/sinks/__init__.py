"""Writers: load modes, layouts, exports, table declarations."""
