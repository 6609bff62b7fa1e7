"""``Column -> Column`` builders; nothing here touches a DataFrame."""
