"""Table operators over grids, layouts and typed sales rows."""
